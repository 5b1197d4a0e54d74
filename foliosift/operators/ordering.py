"""Positions and running sums over a whole table, without passing its rows to the driver.

Rows are range-partitioned, sorted and stored once, and each stored row knows its part and
its place in the part. A position is then the place plus what all earlier parts hold, and
that is a prefix sum over one row for each part.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliosift.session import written

# Fixed value: ``monotonically_increasing_id`` numbers the rows of a partition in its low bits.
ROW_BITS = 33
# Parts whose starts are added up by one task of the first level of the prefix sum.
PARTS_OF_A_GROUP = 1024
PART = f"shiftright(_at, {ROW_BITS})"
PLACE = f"_at & {(1 << ROW_BITS) - 1}"


def total_order(df, order):
    """Sort keys that only exact copies share: the named columns, then all others.

    A name with ``-`` in front is descending. Nulls come first, or last where descending.
    """
    named = [name.removeprefix("-") for name in order]
    keys = [F.desc(n) if o.startswith("-") else F.asc(n) for o, n in zip(order, named, strict=True)]
    return keys + [F.asc(c) for c in df.columns if c not in named]


def sorted_rows(df, keys, label="ordered"):
    """``df`` stored in the order of ``keys``, with its part and place in ``_at``.

    The rows are stored before they are sorted, with a number that makes every sort key
    distinct. So copies that are a third of all rows spread over many tasks, and a task that
    runs again sorts the same rows to the same places.
    """
    keys = [*keys, F.asc("_copy")]
    rows = written(df.withColumn("_copy", F.monotonically_increasing_id()), "unordered")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_copy")
    return written(rows.withColumn("_at", F.monotonically_increasing_id()), label)


def part_starts(totals, width=PARTS_OF_A_GROUP):
    """(_part, _start) from (_part, _sum): what all earlier parts add up to.

    A prefix sum in two levels: inside groups of ``width`` parts, then over the groups.
    """
    earlier = lambda name: F.coalesce(name, F.lit(0))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = totals.withColumn("_group", F.floor(F.col("_part") / width))
    inside = F.sum("_sum").over(before.partitionBy("_group"))
    groups = parts.groupBy("_group").agg(F.sum("_sum").alias("_all"))
    over = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select("_group", earlier(F.sum("_all").over(over)).alias("_before"))
    parts = parts.select("_part", "_group", earlier(inside).alias("_inside"))
    starts = parts.join(groups, "_group").select(
        "_part", (F.col("_before") + F.col("_inside")).cast("bigint").alias("_start")
    )
    # Stored, so that Spark knows its size, one row a part, when it joins the starts.
    return written(starts, "starts")


def numbered(df, keys, position="position"):
    """Number rows from 0 in the order of ``keys``; rows of equal keys one after the other."""
    rows = sorted_rows(df, keys)
    starts = part_starts(rows.groupBy(F.expr(PART).alias("_part")).agg(F.count("*").alias("_sum")))
    placed = rows.withColumn("_part", F.expr(PART)).join(starts, "_part")
    return placed.select(*df.columns, (F.col("_start") + F.expr(PLACE)).alias(position))


def running_total(df, keys, value, total):
    """Add ``total``: the sum of the integer column ``value`` up to and including each row.

    Rows follow the order of ``keys``. Inside a part a window adds up, so no task holds more
    than one part of the sort.
    """
    rows = sorted_rows(df, keys).withColumn("_part", F.expr(PART))
    starts = part_starts(rows.groupBy("_part").agg(F.sum(value).alias("_sum")))
    inside = F.sum(value).over(W.partitionBy("_part").orderBy("_at"))
    placed = rows.withColumn("_inside", inside).join(starts, "_part")
    return placed.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(total))
