import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from foliosift import session
from foliosift.operators import ordering as O
from foliosift.operators import paging as P
from foliosift.operators.ordering import total_order
from foliosift.session import scratch_path, written
from foliosift.sources.applications import append_batch


def apps(spark, n=1000):
    return spark.range(n).select(
        F.concat(F.lit("a"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("application_number"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("filing_date"),
    )


def test_pages_follow_each_other(spark):
    frame = apps(spark)
    whole = [r.application_number for r in frame.orderBy(*P.newest_first()).collect()]
    get = lambda n: [r.application_number for r in P.page(frame, n, size=400).collect()]
    found = [get(n) for n in range(4)]
    assert sum(found, []) == whole and [len(rows) for rows in found] == [400, 400, 200, 0]


def tied(spark):
    """Few dates, some of them null, and copies that are a third of all rows."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int"))
    frame = spark.range(0, 900, 1, 5).select(
        F.when(F.col("id") % 3 == 0, F.lit("c")).otherwise(F.concat(F.lit("d"), F.col("id") % 97)).alias("application_number"),
        F.when(F.col("id") % 5 > 0, day).alias("filing_date"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("n"),
    )
    return written(frame, "tied")


@pytest.mark.parametrize("order", [["-filing_date"], ["n", "-filing_date"]])
def test_pages_of_ties_hold_each_row_once(spark, order):
    frame = tied(spark)
    want = [tuple(r) for r in frame.orderBy(*total_order(frame, order)).collect()]
    by_number = [tuple(r) for n in range(3) for r in P.page(frame, n, 310, order).collect()]
    assert by_number == want and len(want) == 900
    cursor, by_cursor = None, []
    for _ in range(3):
        rows = P.page_after(frame, cursor, 310, order)
        by_cursor += [tuple(r) for r in rows.collect()]
        cursor = P.cursor_after(rows, cursor, order)
    assert by_cursor == want
    assert P.page_after(frame, cursor, 130, order).count() == 0
    assert P.page(frame.limit(0), 0, 130, order).count() == 0


def test_file_numbers_compare_as_numbers(spark):
    names = ["b/part-99999-x", "b/part-100000-x", "b/part-100001-x", "a/batch=9/part-5", "a/batch=10/part-1"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").orderBy(P._counting("name"))
    assert [r.name for r in rows.collect()] == ["a/batch=9/part-5", "a/batch=10/part-1", *names[:3]]


def test_later_batches_move_no_row(spark, tmp_path):
    path = str(tmp_path / "table")
    place = lambda: {r.application_number: r.position for r in P.in_stored_order(spark.read.parquet(path)).collect()}
    append_batch(apps(spark, 500).repartition(4), path, 9)
    before = place()
    append_batch(apps(spark, 900).filter("application_number >= 'a000500'").repartition(4), path, 10)
    after = place()
    assert before == {k: v for k, v in after.items() if k in before}
    assert sorted(after.values()) == list(range(900))


def test_prefix_sums_in_two_levels(spark):
    totals = spark.createDataFrame([(p, p + 1) for p in range(50) if p % 7], "_part long, _sum long")
    found = {r._part: r._start for r in O.part_starts(totals, width=8).collect()}
    assert found == {p: sum(q + 1 for q in range(p) if q % 7) for p in range(50) if p % 7}


def test_running_total(spark):
    frame = spark.range(0, 3000, 1, 6).selectExpr("id", "id % 11 as k", "id % 13 as v")
    rows = sorted(O.running_total(frame, [F.asc("k"), F.asc("id")], "v", "t").collect(), key=lambda r: (r.k, r.id))
    total = 0
    for row in rows:
        total += row.v
        assert row.t == total


def test_numbered(spark):
    frame = apps(spark).repartition(7, "filing_date")
    rows = O.numbered(frame, [F.asc("application_number")]).collect()
    assert all(int(row.application_number[1:]) == row.position for row in rows) and len(rows) == 1000


@pytest.mark.parametrize("stored", [True, False])
def test_numbered_copies(spark, tmp_path, stored):
    """A third of the rows are copies; they spread over the ranges and all get a number."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit("c")).otherwise(F.concat(F.lit("d"), F.lpad("id", 6, "0")))
    frame = spark.range(0, n, 1, 6).select(key.alias("application_number"), F.col("id") % 2)
    if stored:
        frame.write.parquet(str(tmp_path / "rows"))
        frame = spark.read.parquet(str(tmp_path / "rows")).filter("application_number <> 'x'")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = O.numbered(frame, [F.asc("application_number")])
    parts = O.sorted_rows(frame, [F.asc("application_number")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    found = rows.collect()
    assert sorted(row.position for row in found) == list(range(n))
    by_position = [row.application_number for row in sorted(found, key=lambda row: row.position)]
    assert by_position == sorted(by_position)
    parts = parts.filter("application_number = 'c'").groupBy(F.expr(O.PART).alias("part")).count().collect()
    assert len(parts) >= 2 and max(r["count"] for r in parts) < n // 3


def test_scratch_needs_a_shared_folder():
    context = SimpleNamespace(master="spark://x:1", getCheckpointDir=lambda: None, applicationId="a1")
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError):
        scratch_path(fake, "x")
    context.master = "local[2]"
    assert scratch_path(fake, "x").startswith(tempfile.gettempdir())
    context.getCheckpointDir = lambda: "hdfs://shared/"
    assert scratch_path(fake, "x").startswith("hdfs://shared/foliosift-a1/x-")
    fake.conf.get = lambda name, default: "s3://named"
    assert scratch_path(fake, "x").startswith("s3://named/foliosift-a1/x-")


def test_scratch_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_folder", lambda spark: str(tmp_path / "mine"))
    written(apps(spark), "apps")
    (tmp_path / "other").mkdir()
    assert len(list((tmp_path / "mine").iterdir())) == 1
    session.remove_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_stored_order(spark, tmp_path):
    path = str(tmp_path / "stored")
    apps(spark).repartitionByRange(5, "application_number").sortWithinPartitions(
        "application_number"
    ).write.parquet(path)
    apps(spark).limit(0).write.mode("append").parquet(path)
    frame = P.in_stored_order(spark.read.parquet(path))
    assert sorted(row.position for row in frame.collect()) == list(range(1000))
    assert all(int(r.application_number[1:]) == r.position for r in frame.collect())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("size, per_bucket", [(50, 100), (7, 3)])
def test_page_summary(spark, size, per_bucket):
    numbered = O.numbered(apps(spark), [F.asc("application_number")])
    rows = P.page_summary(P.with_pages(numbered, size, per_bucket)).orderBy("page").collect()
    assert [row.page for row in rows] == list(range(-(-1000 // size)))
    assert all(row.bucket == row.page // per_bucket for row in rows)
    assert sum(row.n_rows for row in rows) == 1000
    last = [min((n + 1) * size, 1000) - 1 for n in range(len(rows))]
    assert [int(row.last_application_number[1:]) for row in rows] == last


def test_pages_between(spark):
    paged = P.with_pages(O.numbered(apps(spark), [F.asc("application_number")]), size=50)
    rows = P.pages_between(paged, 3, 5).collect()
    assert sorted(row.position for row in rows) == list(range(150, 250))
