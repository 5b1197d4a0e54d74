"""Landed JSON files: every object becomes a row, or a row with the reason why it cannot."""

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A record begins where a line begins with a brace; pretty printers indent all inner ones.
RECORD_START = "\n{"
CORRUPT = "_corrupt"
MALFORMED = "malformed JSON"


def _splitter():
    # All names are local, so that the function travels to the workers by value.
    token, marks = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.S), " \t\r\n,[]"

    def pieces(text):
        depth = start = end = 0
        for found in token.finditer(text):
            mark = found.group()
            if mark == "{":
                if depth == 0:
                    yield text[end : found.start()]
                    start = found.start()
                depth += 1
            elif mark == "}" and depth:
                depth -= 1
                if depth == 0:
                    end = found.end()
                    yield text[start:end]
        yield text[start if depth else end :]

    def split(texts: pa.Array) -> pa.Array:
        rows = [
            None if text is None else [p for piece in pieces(text) if (p := piece.strip(marks))]
            for text in texts.to_pylist()
        ]
        return pa.array(rows, pa.list_(pa.string()))

    return split


_split_objects = F.arrow_udf(_splitter(), T.ArrayType(T.StringType()))


def landed_objects(spark, path):
    """(file, object) for each top-level object in JSON files, as text.

    Objects may span lines, share a line or stand in an array. Files are cut where a line
    begins with a brace, in parallel also inside a large file, so a damaged object damages
    no other line. The few pieces that do not look like a single object are scanned in Arrow
    batches. A piece without an object is a row as well; blank pieces are none.
    """
    lines = spark.read.option("lineSep", RECORD_START).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value")
    # Only the first piece of a file still has its brace.
    first = F.col("value").rlike(r"\A[\s﻿]*[{\[]")
    text = F.when(first, F.col("value")).otherwise(F.concat(F.lit("{"), "value"))
    text = F.regexp_replace(text, r"\A[\s﻿]+|[\s,\]]+\z", "")
    pieces = lines.filter(r"value rlike '\\S'").select("file", text.alias("text"))
    single = F.col("text").rlike(r"\A\{") & F.col("text").rlike(r"\}\z")
    single = single & ~F.col("text").rlike(r"\}\s*\{")
    split = _split_objects(F.when(~single, F.col("text")))
    objects = F.when(single, F.array("text")).otherwise(split)
    return pieces.select("file", F.explode(objects).alias("object"))


def parsed_objects(objects, schema, required):
    """(file, object, record, reason) of landed objects; the record is null with a reason.

    An object needs the field ``required`` to be used.
    """
    kind = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = objects.withColumn("_read", F.from_json("object", kind, options))
    reason = F.when(F.col("_read").isNull() | F.col(f"_read.{CORRUPT}").isNotNull(), F.lit(MALFORMED)).when(
        F.col(f"_read.{required}").isNull(), F.lit(f"no {required}")
    )
    record = F.struct(*(F.col(f"_read.{name}").alias(name) for name in schema.names))
    return read.select(
        "file", "object", F.when(reason.isNull(), record).alias("record"), reason.alias("reason")
    )


def read_landed(spark, path, schema, required):
    """Two tables of JSON files: the records, and (file, object, reason) for what is none."""
    rows = parsed_objects(landed_objects(spark, path), schema, required)
    good = rows.filter("reason is null").select("record.*")
    return good, rows.filter("reason is not null").select("file", "object", "reason")
