"""Document listings and payloads."""

from pyspark.sql import functions as F

from foliosift.schemas import DOCUMENT_LISTING, PAYLOADS
from foliosift.sources.landed import read_landed


def landed_listings(spark, path):
    """Landed document listings, and (file, object, reason) of those that cannot be used."""
    return read_landed(spark, path, DOCUMENT_LISTING, "application_number")


def read_listings(spark, path):
    """Landed document listings, one row for each application."""
    return landed_listings(spark, path)[0]


def read_payload_table(spark, path):
    """Payloads stored as (url, content): the form to use for many small documents."""
    return spark.read.schema(PAYLOADS).parquet(path)


def read_payload_files(spark, path, url=None, pattern="*.xml"):
    """Payloads landed as files. ``url`` maps the file path to the listed URL."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = files.option("recursiveFileLookup", "true").load(path)
    return files.select((F.col("path") if url is None else url).alias("url"), "content")
