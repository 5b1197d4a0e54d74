"""Application records in and out."""

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from foliosift.functions.codes import joined_codes, split_codes
from foliosift.schemas import APPLICATION_COLUMNS, APPLICATIONS, SEARCH_RESPONSE
from foliosift.sources.landed import read_landed

# Field of a raw record and column of an application row.
COLUMN_OF_FIELD = {
    "applicationNumberText": "application_number",
    "patentNumber": "patent_number",
    "cpcClassificationBag": "cpcs",
    "filingDate": "filing_date",
    "inventionTitle": "invention_title",
    "grantDate": "grant_date",
    "applicationStatusCode": "status_code",
    "applicationStatusDescriptionText": "status_desc",
}
RECORD_LIST = "patentFileWrapperDataBag"
TYPE_FIELD, TYPE_COLUMN = "applicationTypeLabelName", "application_type"


def landed_search_responses(spark, path):
    """Raw records of landed search responses, and the responses that cannot be used.

    Responses are JSON objects in any layout. One that is cut short, no JSON, or without a
    list of records is a row (file, object, reason) of the second table.
    """
    responses, broken = read_landed(spark, path, SEARCH_RESPONSE, RECORD_LIST)
    return responses.select(F.inline(RECORD_LIST)), broken


def read_search_responses(spark, path):
    """Raw records of landed search responses, one row each."""
    return landed_search_responses(spark, path)[0]


def flattened(records, nested):
    """Lift the fields of struct ``nested`` to the top; on a name clash they win."""
    inner = records.schema[nested].dataType.names
    outer = [name for name in records.columns if name != nested]
    kept = [F.col(name) for name in outer if name not in inner]
    for name in inner:
        value = F.col(f"{nested}.{name}")
        kept.append((F.coalesce(value, F.col(name)) if name in outer else value).alias(name))
    return records.select(*kept)


def application_rows(records, with_type=False):
    """Raw records to application rows; with the application type only for facets."""
    flat = flattened(records, "applicationMetaData")
    columns = []
    for field, name in COLUMN_OF_FIELD.items():
        kind = APPLICATIONS[name].dataType
        value = F.col(field).try_cast(kind) if kind.typeName() == "date" else F.col(field)
        columns.append(value.alias(name))
    if with_type:
        columns.append(F.col(TYPE_FIELD).alias(TYPE_COLUMN))
    return flat.select(*columns)


def read_applications(spark, path):
    """Stored application rows."""
    return spark.read.schema(APPLICATIONS).parquet(path)


def csv_layouts(spark, path):
    """(names, files) for each header that the CSV files of ``path`` have.

    The first line of a file is the first row of its first block. Only the distinct headers and
    the names of the files, which the driver lists anyway, come back.
    """
    at = F.monotonically_increasing_id().alias("at")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", at
    )
    headers = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    for row in headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect():
        names, seen = next(csv.reader([row["header"].lstrip("\ufeff")]), []), set()
        for i, name in enumerate(names):
            # Columns without a name of their own are kept apart and not used.
            names[i] = name if name and name not in seen else f"_unnamed_{i}"
            seen.add(name)
        yield names, [unquote(file) for file in row["files"]]


def read_applications_csv(spark, path, multiline=True):
    """Application rows of CSV files with a header; columns are taken by name in each file.

    Files may differ in the columns they have and in their order. Identifiers stay text and
    columns that a file lacks are null. ``multiline`` reads line ends inside quotes; without,
    large files are split.
    """
    rows = [_csv_rows(spark, names, files, multiline) for names, files in csv_layouts(spark, path)]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], APPLICATIONS)


def _csv_rows(spark, names, files, multiline):
    schema = StructType([StructField(name, StringType()) for name in names])
    table = spark.read.schema(schema).csv(files, header=True, quote='"', escape='"', multiLine=multiline)
    columns = []
    for field in APPLICATIONS:
        if field.name not in table.columns:
            value = F.lit(None).cast(field.dataType)
        elif field.name == "cpcs":
            value = split_codes(F.col("cpcs"))
        else:
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return table.select(*columns)


def append_applications(apps, path):
    """Add application rows to a stored table."""
    apps.select(*APPLICATION_COLUMNS).write.mode("append").parquet(path)


def append_batch(rows, path, batch_id):
    """Add ``rows`` as batch ``batch_id`` of a stored table, in their order.

    A batch owns one folder and replaces it when it is written again. Numbers by
    ``in_stored_order`` follow the batches, so later batches move no earlier row.
    """
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def replace_applications(apps, path):
    """Store application rows in place of what was there."""
    apps.write.mode("overwrite").parquet(path)


def export_csv(rows, path, mode="append"):
    """CSV with a header in each file; code lists become comma-joined text.

    Blanks at the ends of values and line ends inside them come back as they are.
    """
    flat = rows.withColumn("cpcs", joined_codes(F.col("cpcs"))) if "cpcs" in rows.columns else rows
    flat.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def append_buckets(paged, path):
    """Add enriched rows to one folder for each ``bucket``.

    A bucket covers a fixed number of rows, so gathering it in one task is bounded.
    """
    paged.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def read_patterns(spark, path):
    """Code patterns, one a line, as a one-column table; lines from ``#`` on are notes."""
    line = F.trim(F.split_part(F.col("value"), F.lit("#"), F.lit(1)))
    return spark.read.text(path).select(line.alias("pattern")).filter("pattern <> ''")
