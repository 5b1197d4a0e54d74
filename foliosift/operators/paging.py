"""Pages and page summaries."""

from functools import reduce

from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.operators.ordering import numbered, running_total, total_order
from foliosift.session import written

NEWEST_FIRST = ("-filing_date", "application_number")


def newest_first(tie_break="application_number"):
    return [F.desc("filing_date"), F.asc(tie_break)]


def page(apps, number, size=V.SEARCH_PAGE_SIZE, order=NEWEST_FIRST):
    """Page ``number``, from 0, of the rows by ``order``; at any depth in the same way.

    ``order`` names columns, with ``-`` in front for descending; all other columns break
    ties, so the pages of a table hold each row exactly once, copies included. Rows are
    counted by the first column alone; the counts tell which of its values the page touches,
    a filter that reaches the scan leaves the others out, and only the rest is numbered.
    """
    keys, lead = total_order(apps, order), order[0].removeprefix("-")
    first = number * size
    counts = apps.groupBy(F.col(lead).alias("_lead")).agg(F.count("*").alias("_rows"))
    by_lead = [F.desc("_lead") if order[0].startswith("-") else F.asc("_lead")]
    ends = running_total(counts, by_lead, "_rows", "_end")
    touched = ends.filter((F.col("_end") > first) & (F.col("_end") - F.col("_rows") < first + size))
    low, high, nulls, before = touched.agg(
        F.min("_lead"), F.max("_lead"), F.count_if(F.col("_lead").isNull()),
        F.min(F.col("_end") - F.col("_rows")),
    ).first()
    if before is None:
        return apps.limit(0)
    inside = F.col(lead).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    if nulls:
        inside = inside | F.col(lead).isNull()
    rows = numbered(apps.filter(inside), keys, "_position")
    wanted = F.col("_position").between(first - before, first + size - 1 - before)
    return rows.filter(wanted).drop("_position").orderBy(*keys)


def page_after(apps, cursor=None, size=V.SEARCH_PAGE_SIZE, order=NEWEST_FIRST):
    """The ``size`` rows that follow the row that ``cursor`` stands for, first ones without.

    The order is that of ``page``. However deep the page, no more than ``size`` rows are
    kept: earlier rows fail the comparison with the cursor. Copies of the cursor's row that
    earlier pages have not held come first.
    """
    keys = total_order(apps, order)
    if cursor is None:
        return apps.orderBy(*keys).limit(size)
    values, taken = cursor
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()))
    left = min(size, apps.filter(same).count() - taken)
    after, equal = F.lit(False), F.lit(True)
    for name in [*_names(order), *(c for c in values if c not in _names(order))]:
        after = after | (equal & _follows(name, values[name], f"-{name}" in order))
        equal = equal & F.col(name).eqNullSafe(F.lit(values[name]))
    copies = apps.filter(same).limit(left)
    rest = apps.filter(after).orderBy(*keys).limit(size - left)
    return copies.unionByName(rest).orderBy(*keys)


def cursor_after(rows, cursor=None, order=NEWEST_FIRST):
    """Cursor for the page after ``rows``, a page of any size; none where it has no rows.

    It holds the values of the last row and how many copies of it the pages so far had.
    """
    keys = total_order(rows, order)
    found = rows.collect()  # one page
    if not found:
        return None
    last = rows.sparkSession.createDataFrame(found, rows.schema).orderBy(*keys).tail(1)[0]
    values = {name: last[name] for name in rows.columns}
    earlier = cursor[1] if cursor and cursor[0] == values else 0
    return values, earlier + sum(row == last for row in found)


def _names(order):
    return [name.removeprefix("-") for name in order]


def _follows(name, value, descending):
    """Whether a column comes after ``value``; nulls first, or last where descending."""
    column = F.col(name)
    if value is None:
        return F.lit(False) if descending else column.isNotNull()
    if descending:
        return column.isNull() | F.coalesce(column < F.lit(value), F.lit(False))
    return F.coalesce(column > F.lit(value), F.lit(False))


def _counting(name):
    """Text in which runs of digits compare as numbers: part-99999 before part-100000."""
    return F.expr(
        f"array_join(transform(regexp_extract_all({name}, '([0-9]+|[^0-9]+)', 1), "
        "p -> if(p >= '0' and p < ':', lpad(p, greatest(20, length(p)), '0'), p)), '')"
    )


def in_stored_order(stored, position="position"):
    """Number the rows of a stored Parquet table from 0 in file order.

    Each row adds its index inside the file to the number of rows in earlier files. Rows are
    neither sorted nor shuffled, and the counts of the files are added up in Spark. Files
    follow each other by path, with numbers in it compared as numbers. A table that grows by
    ``append_batch`` keeps the positions of its earlier rows.
    """
    name = F.col("_metadata.file_path")
    counts = stored.groupBy(name.alias("_file")).agg(F.count("*").alias("_rows"))
    ends = running_total(counts, [_counting("_file").asc(), F.asc("_file")], "_rows", "_end")
    starts = ends.select("_file", (F.col("_end") - F.col("_rows")).alias("_start"))
    rows = stored.select("*", name.alias("_file"), F.col("_metadata.row_index").alias("_index"))
    # Stored, so that Spark knows its size, one row a file, and broadcasts it where that is small.
    return rows.join(written(starts, "files"), "_file").select(
        *stored.columns, (F.col("_start") + F.col("_index")).alias(position)
    )


def with_pages(
    numbered_rows,
    size=V.DETAIL_PAGE_SIZE,
    pages_per_bucket=V.PAGES_PER_BUCKET,
    position="position",
):
    """Add ``page`` and the output ``bucket`` that its page falls into."""
    page_number = F.floor(F.col(position) / F.lit(size)).cast("bigint")
    return numbered_rows.withColumn("page", page_number).withColumn(
        "bucket", F.floor(F.col("page") / F.lit(pages_per_bucket)).cast("bigint")
    )


def pages_between(paged, first, last):
    """Rows of the pages from ``first`` up to, but not including, ``last``."""
    return paged.filter((F.col("page") >= first) & (F.col("page") < last))


def page_summary(paged, key="application_number", position="position"):
    """Rows and last key of each page."""
    return paged.groupBy("bucket", "page").agg(
        F.count("*").alias("n_rows"), F.max_by(key, position).alias(f"last_{key}")
    )
