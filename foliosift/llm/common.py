"""Helpers of the corpus operators."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Documents that one step of a Python worker holds decoded at a time.
BLOCK_ROWS = 256
# Bits that tell which rows a join may need; and fixed value: bits of one map of Spark's.
BITS, MAP_BITS = 1 << 24, 32768


def lowered(column):
    """A-Z in lower case; other letters stay."""
    return F.translate(column, UPPER, LOWER)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def name_of(column):
    return F.col(f"`{column}`")


def with_columns(df, new, columns, row="row"):
    """``columns`` from the struct ``row``; those in ``new`` replace or follow them."""
    kept = [new[c].alias(c) if c in new else F.col(f"{row}.`{c}`") for c in columns]
    return df.select(*kept, *(new[c].alias(c) for c in new if c not in columns))


def row_of(docs, *without):
    """All columns but some as one struct, so that working columns beside it cannot clash."""
    kept = [name_of(c) for c in docs.columns if c not in without]
    return F.struct(*(kept or [F.lit(0).alias("_")])).alias("row")


def packed(docs, key="doc_id", text="text"):
    """(key, text, row): the text is not null, and ``row`` has the other columns."""
    return docs.select(
        name_of(key).alias("key"),
        F.coalesce(name_of(text).cast("string"), F.lit("")).alias("text"),
        row_of(docs, text),
    )


def texts(docs, key="doc_id", text="text"):
    """(key, text) alone; a null text is empty."""
    return packed(docs, key, text).select("key", "text")


def likely_in(rows, wanted, columns, others=False):
    """``rows`` without most of those whose ``columns`` are not in ``wanted``; a join follows.

    A bitmap of ``BITS`` bits, at most 2 MB whatever ``wanted`` holds, is broadcast and drops
    rows before they are shuffled. A row that is wanted always stays. ``others`` gives exactly
    the rows that are dropped instead.
    """
    slot = F.pmod(F.xxhash64(*columns), F.lit(BITS)).alias("_slot")
    number, place = f"_slot div {MAP_BITS}", f"_slot % {MAP_BITS}"
    maps = wanted.select(slot).groupBy(F.expr(number).alias("_map"))
    maps = maps.agg(F.bitmap_construct_agg(F.expr(place)).alias("_bits"))
    byte = f"conv(hex(substring(_bits, cast({place} div 8 as int) + 1, 1)), 16, 10)"
    bit = f"shiftright(cast({byte} as int), cast(_slot % 8 as int)) & 1"
    found = rows.select("*", slot).join(
        F.broadcast(maps), F.expr(number) == F.col("_map"), "left" if others else "inner"
    )
    return found.filter(f"coalesce({bit}, 0) = 0" if others else f"{bit} = 1").select(*rows.columns)


def row_batches(batches, rows=BLOCK_ROWS):
    """Arrow batches cut into slices of a bounded number of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_batches(batches, most, column="text"):
    """Arrow batches cut into slices of about ``most`` bytes of a text column, one row at least.

    Without a column, slices of ``BLOCK_ROWS`` rows.
    """
    if column is None:
        yield from row_batches(batches)
        return
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths) // most
        starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            if end > start:
                yield batch.slice(start, end - start)


def byte_texts(batch, column="text"):
    """The texts of a batch as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def code_points(data):
    """Number of code points of UTF-8 bytes."""
    return len(data.decode())
