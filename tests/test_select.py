import random

import pytest
from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.functions.codes import joined_codes, split_codes
from foliosift.operators import select as S
from foliosift.plans.selection import searched, selected

SCHEMA = (
    "application_number string, cpcs array<string>, invention_title string, "
    "status_desc string, filing_date date"
)


def apps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn(
        "filing_date", F.coalesce("filing_date", F.lit("2020-01-01").cast("date"))
    )


def numbers(df):
    return sorted(row.application_number for row in df.collect())


def test_selection_rules(spark):
    rows = [
        ("kept", ["H01L 23/00"], "Cooling Plate", "Patented Case", None),
        ("nothing known", None, None, None, None),
        ("no codes", [], "Plate", "Docketed", None),
        ("null code", [None, "H05K7/20"], "Plate", "Docketed", None),
        ("prefix", ["H05K7/20", "G06F3/01"], "Plate", None, None),
        ("longer prefix", ["G06F30/20"], "Plate", None, None),
        ("section", ["A61B5/00"], "Plate", None, None),
        ("padded", ["G06 T3/40"], "Plate", None, None),
        ("tab in front", ["\tG06Q10/00"], "Plate", None, None),
        ("upper case term", ["H05K7/20"], "A MEDICAL Plate", None, None),
        ("term inside", ["H05K7/20"], "Biotechnology", None, None),
        ("quote", ["H05K7/20"], "On Parkinson's", None, None),
        ("long s", ["H05K7/20"], "diſease", None, None),
        ("vehicle", ["H05K7/20"], "Autonomous vehicles", None, None),
        ("near vehicle", ["H05K7/20"], "autonomous vessel", None, None),
        ("status", ["H05K7/20"], "Plate", "Final Rejection Mailed", None),
        ("two spaces", ["H05K7/20"], "Plate", "Expressly Abandoned  --  During Examination", None),
        ("one space", ["H05K7/20"], "Plate", "Expressly Abandoned -- During Examination", None),
    ]
    kept = selected(apps(spark, rows))
    assert numbers(kept) == sorted(
        ["kept", "nothing known", "no codes", "null code", "near vehicle", "one space"]
    )
    row = kept.filter("application_number = 'kept'").first()
    assert (row.cpcs, row.invention_title) == (["H01L23/00"], "cooling plate")


def test_terms_are_plain_text(spark):
    rows = [("dot", None, "a.b", None, None), ("other", None, "axb", None, None)]
    assert numbers(S.without_title_terms(apps(spark, rows), ["a.b"])) == ["other"]
    rows = [("q", None, r"x\Ey", None, None), ("other", None, "xy", None, None)]
    assert numbers(S.without_title_terms(apps(spark, rows), [r"x\Ey"])) == ["other"]
    assert numbers(S.without_title_terms(apps(spark, rows), [])) == ["other", "q"]


def test_filing_dates_include_both_ends(spark):
    days = ["2018-08-03", "2018-08-04", "2026-01-01", "2026-01-02"]
    frame = spark.createDataFrame([(d,) for d in days], "application_number string")
    frame = frame.withColumn("filing_date", F.col("application_number").cast("date"))
    assert numbers(S.filed_between(frame)) == ["2018-08-04", "2026-01-01"]


CODES = [
    ("exact", ["G06N3/08"]),
    ("padded", ["G06N  3/08"]),
    ("longer", ["G06N3/084"]),
    ("prefix", ["G06N20/10"]),
    ("bare prefix", ["G06N20/"]),
    ("both", ["G06N20/10", "G06N3/08"]),
    ("none", ["G06N7/00", None]),
    ("empty", []),
    ("null", None),
]
PATTERNS = ["G06N3/08", "G06N20/*"]


def code_rows(spark):
    return apps(spark, [(name, codes, None, None, None) for name, codes in CODES])


def test_include_patterns(spark):
    expected = sorted(["exact", "padded", "prefix", "bare prefix", "both"])
    frame = code_rows(spark)
    table = spark.createDataFrame([(p,) for p in [*PATTERNS, "G06N 3/08"]], "pattern string")
    empty = table.filter("false")
    assert numbers(S.with_codes_matching(frame, PATTERNS)) == expected
    assert numbers(S.with_codes_matching(frame, table)) == expected
    for nothing in (None, [], empty):
        assert numbers(S.with_codes_matching(frame, nothing, PATTERNS)) == expected
    with pytest.raises(ValueError):
        S.with_codes_matching(frame, None)


def test_lists_and_tables_agree(spark):
    frame = code_rows(spark)
    table = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    joined, inline = S.with_codes_matching(frame, table), numbers(S.with_codes_matching(frame, PATTERNS))
    assert numbers(joined) == inline
    rest = numbers(S.without_codes_matching(frame, PATTERNS))
    assert numbers(S.without_codes_matching(frame, table)) == rest
    assert sorted(inline + rest) == sorted(name for name, _ in CODES)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("count", [3, 7000])
def test_rows_of_one_number_are_judged_one_by_one(spark, count):
    """One rule, however many patterns there are."""
    rows = [("1", ["A1"]), ("1", ["B1"]), (None, ["A1"]), (None, ["B1"]), ("2", None), (None, None), ("3", [])]
    frame = apps(spark, [(name, codes, None, None, None) for name, codes in rows])
    patterns = ["A1", *(f"Z{n}" for n in range(count))]
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    kept = S.with_codes_matching(frame, table).collect()
    assert [(r.application_number, r.cpcs) for r in sorted(kept, key=repr)] == [("1", ["A1"]), (None, ["A1"])]
    gone = S.without_codes_matching(frame, table)
    assert gone.count() == 5 and gone.filter("application_number is null").count() == 2


def test_patterns_become_disjoint(spark):
    patterns = ["A*", "AB*", "A1", "B1", "B1*", "B12", "C 3", "C3", "D*", "D*", "E1*", "E2", "E"]
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = {(r.text, r.is_prefix) for r in S.disjoint_patterns(table).collect()}
    assert found == {("A", True), ("B1", True), ("C3", False), ("D", True), ("E1", True), ("E2", False), ("E", False)}
    everything = spark.createDataFrame([("*",), ("A*",), ("B",)], "pattern string")
    assert [tuple(r) for r in S.disjoint_patterns(everything).collect()] == [("", True)]
    assert numbers(S.with_codes_matching(code_rows(spark), everything)) == sorted(n for n, c in CODES if c)


def test_predicate_and_join_agree_with_plain_prefixes(spark):
    draw = random.Random(3)
    code = lambda: "".join(draw.choice("AB1") for _ in range(draw.randint(1, 5)))
    rows = [(str(n), [code() for _ in range(draw.randint(0, 4))]) for n in range(1500)]
    patterns = list({code() + draw.choice(["", "*"]) for _ in range(12)})
    hit = lambda c: any(c.startswith(p[:-1]) if p[-1] == "*" else c == p for p in patterns)
    expected = sorted(name for name, codes in rows if any(map(hit, codes)))
    frame = apps(spark, [(name, codes, None, None, None) for name, codes in rows])
    assert numbers(S.with_codes_matching(frame, patterns)) == expected
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    assert numbers(S.with_codes_matching(frame, table)) == expected


def test_code_text_round_trip(spark):
    rows = [(1, ["A 1", "B2"]), (2, []), (3, None)]
    frame = spark.createDataFrame(rows, "n int, cpcs array<string>")
    text = frame.select("n", joined_codes(F.col("cpcs")).alias("t"))
    assert [r.t for r in text.orderBy("n").collect()] == ["A 1,B2", "[]", None]
    back = text.select("n", split_codes(F.col("t")).alias("c")).orderBy("n").collect()
    assert [r.c for r in back] == [["A1", "B2"], [], None]


def test_fixed_lists():
    sizes = (V.EXCLUDED_CODE_PREFIXES, V.MEDICAL_TITLE_TERMS, V.VEHICLE_TITLE_TERMS, V.DROPPED_STATUSES)
    assert [len(values) for values in sizes] == [12, 9, 1, 10]


def stored(spark, tmp_path, frame):
    path = str(tmp_path / "apps")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_has_no_shuffle_and_dates_reach_the_scan(spark, tmp_path):
    frame = stored(spark, tmp_path, code_rows(spark))
    assert "Exchange" not in plan_of(selected(frame))
    found = plan_of(searched(frame, PATTERNS).select("application_number"))
    assert "Exchange" not in found and "Join" not in found
    assert "GreaterThanOrEqual(filing_date,2018-08-04)" in found
    assert "invention_title" not in found
