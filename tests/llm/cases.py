"""Small tables with awkward rows, and helpers of the operator tests."""

import glob
import os

import pyarrow.dataset as ds

# Columns with names that the operators use inside.
SCHEMA = "doc_id long, text string, key string, row int, hits string, n int, page string, own int"


def documents(spark, texts, partitions=3):
    """One row for each (doc_id, text), with clashing columns."""
    rows = [(i, t, f"k{n}", n, "h", n % 3, None, 7) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(folder, table):
    """Rows of a given table as dictionaries."""
    path = f"{folder}/{table}.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
    return ds.dataset(files).to_table().to_pylist()


def rows(df, *names):
    """Sorted tuples of the named columns."""
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
