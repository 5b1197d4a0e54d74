import random

import pytest
from pyspark.sql import functions as F

from foliosift.operators.reduce import TEXTS_OF_TYPE, attached, before_stop, best_texts, longest_texts
from foliosift.operators.references import listed_documents, xml_references
from foliosift.plans.enrichment import application_texts, file_texts
from foliosift.schemas import DOCUMENT_LISTING
from xml_text import words

FILES = "application_number string, doc_type string, seq bigint, abstract string, background string, summary string"
TEXTS = ["abstract", "background", "summary"]


def best(spark, rows):
    frame = spark.createDataFrame(rows, FILES)
    sized = frame.withColumns({f"len_{name}": F.length(name) for name in TEXTS})
    found = best_texts(before_stop(sized)).collect()
    return {row.application_number: tuple(row[name] for name in TEXTS) for row in found}


def test_early_stop_and_ties(spark):
    t = words
    rows = [
        ("stop at 300", "ABST", 0, t(300, "a"), None, None),
        ("stop at 300", "ABST", 1, t(400, "b"), None, None),
        ("go on at 299", "ABST", 0, t(299, "a"), None, None),
        ("go on at 299", "ABST", 1, t(400, "b"), None, None),
        ("first of equals", "ABST", 5, "later", None, None),
        ("first of equals", "ABST", 2, "early", None, None),
        ("one is not enough", "SPEC", 0, None, t(300, "b"), ""),
        ("one is not enough", "SPEC", 1, None, t(310, "c"), t(301, "s")),
        ("one is not enough", "SPEC", 2, None, t(999, "d"), t(999, "z")),
        ("nothing found", "SPEC", 0, None, "", ""),
        ("no payload", "SPEC", 0, None, None, None),
        ("own type only", "SPEC", 0, t(500, "x"), "b", "s"),
        ("own type only", "ABST", 9, "a", t(500, "y"), t(500, "z")),
        ("types stop apart", "ABST", 0, t(300, "a"), None, None),
        ("types stop apart", "SPEC", 1, None, "b", "s"),
    ]
    assert best(spark, rows) == {
        "stop at 300": (t(300, "a"), "", ""),
        "go on at 299": (t(400, "b"), "", ""),
        "first of equals": ("early", "", ""),
        "one is not enough": ("", t(310, "c"), t(301, "s")),
        "nothing found": ("", "", ""),
        "no payload": ("", "", ""),
        "own type only": ("a", "b", "s"),
        "types stop apart": (t(300, "a"), "b", "s"),
    }


def expected_best(files):
    found = dict.fromkeys(TEXTS, "")
    for _, kind, _, *texts in sorted(files, key=lambda file: file[2]):
        supplied = dict(zip(TEXTS, texts))
        wanted = TEXTS_OF_TYPE[kind]
        if min(len(found[name]) for name in wanted) < 300:
            for name in wanted:
                found[name] = max(found[name], supplied[name] or "", key=len)
    return tuple(found[name] for name in TEXTS)


@pytest.mark.parametrize("files_each", [4, 40])
def test_random_files(spark, files_each):
    draw = random.Random(files_each)
    apps, rows = {}, []
    for number in range(6000 // files_each):
        for seq in draw.sample(range(500), draw.randint(1, files_each)):
            text = lambda: draw.choice([None, "", *(words(n, str(draw.random())) for n in (90, 299, 300, 301, 350, draw.randint(60, 420)))])
            row = (str(number), draw.choice(["SPEC", "ABST"]), seq, text(), text(), text())
            apps.setdefault(str(number), []).append(row)
            rows.append(row)
    assert best(spark, rows) == {name: expected_best(files) for name, files in apps.items()}


def test_one_application_with_most_files(spark, tmp_path):
    """The files of a hot application meet its stop in many tasks, with the same result."""
    n = 40_000
    hot = spark.range(n).select(
        F.lit("hot").alias("application_number"),
        F.lit("SPEC").alias("doc_type"),
        F.col("id").alias("seq"),
        F.lit(None).cast("string").alias("abstract"),
        F.repeat(F.lit("b"), F.when(F.col("id") == n - 500, 300).otherwise(7)).alias("background"),
        F.repeat(F.lit("s"), F.when(F.col("id") % 1000 == 999, 320).otherwise(9)).alias("summary"),
    )
    late = hot.filter("seq = 0").withColumn("seq", F.lit(n)).withColumn("summary", F.repeat(F.lit("z"), F.lit(999)))
    hot.union(late).write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    sized = files.withColumns({f"len_{name}": F.length(name) for name in TEXTS})
    kept = before_stop(sized)
    assert kept.count() == n - 500 + 1
    row = best_texts(kept).first()
    assert (row.background, row.summary) == ("b" * 300, "s" * 320)
    spread = sized.select(F.pmod(F.xxhash64("seq"), F.lit(32)).alias("p")).distinct().count()
    assert spread == 32
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Window" not in plan


def test_longest_texts(spark):
    rows = [(1, 2, "bb"), (1, 1, "aa"), (1, 3, "c"), (2, 1, None)]
    frame = spark.createDataFrame(rows, "k int, n int, text string")
    found = longest_texts(frame, ["k"], ["text"], F.col("n")).orderBy("k").collect()
    assert [(row.k, row.text) for row in found] == [(1, "aa"), (2, "")]


def option(url, mime="XML"):
    return {"downloadUrl": url, "mimeTypeIdentifier": mime}


def bag(code, *options):
    return {"documentCode": code, "downloadOptionBag": list(options)}


def listings(spark):
    rows = [
        ("two types", [bag("ABST", option("a1")), bag("CLM", option("c")), bag("SPEC", option("s1"), option("s2", "PDF")), bag("SPEC", option("s3"))]),
        ("same url", [bag("SPEC", option("x"), option("y")), bag("ABST", option("x"))]),
        ("no xml", [bag("SPEC", option("p", "PDF"))]),
        ("no options", [{"documentCode": "SPEC", "downloadOptionBag": None}]),
        ("no bag", None),
        ("empty bag", []),
    ]
    return spark.createDataFrame(rows, DOCUMENT_LISTING)


def test_references(spark):
    documents = listed_documents(listings(spark))
    order = {}
    for row in documents.orderBy("application_number", "seq").collect():
        order.setdefault(row.application_number, []).append((row.doc_type, row.url))
    assert order == {
        "two types": [("SPEC", "s1"), ("SPEC", "s2"), ("SPEC", "s3"), ("ABST", "a1")],
        "same url": [("SPEC", "x"), ("SPEC", "y"), ("ABST", "x")],
        "no xml": [("SPEC", "p")],
    }
    rows = xml_references(documents).collect()
    found = sorted((r.application_number, r.seq, r.url, r.doc_type) for r in rows)
    assert found == [
        ("same url", 0, "x", "ABST"),
        ("same url", 1, "y", "SPEC"),
        ("two types", 0, "s1", "SPEC"),
        ("two types", 2, "s3", "SPEC"),
        ("two types", 2**31, "a1", "ABST"),
    ]


def test_shared_url_and_missing_payload(spark):
    """A URL that most applications share, and references without any payload."""
    shared = spark.range(5000).select(
        F.col("id").cast("string").alias("application_number"),
        F.lit("shared").alias("url"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit("ABST").alias("doc_type"),
    )
    lonely = shared.limit(1).select(F.lit("lonely").alias("application_number"), F.lit("gone").alias("url"), "seq", "doc_type")
    pieces = spark.createDataFrame(
        [("shared", 0, "one", None, None), ("shared", 1, "longer", None, None), ("shared", 2, "equals", None, None)],
        "url string, piece int, abstract string, background string, summary string",
    )
    rows = application_texts(shared.union(lonely), file_texts(pieces))
    counts = rows.groupBy("abstract").count().collect()
    assert {row.abstract: row["count"] for row in counts} == {"longer": 5000, "": 1}


def test_attached_keeps_every_row(spark):
    apps = spark.createDataFrame(
        [("1", "a"), ("1", "b"), ("2", "c"), ("3", "d"), (None, "e")], "application_number string, title string"
    )
    texts = spark.createDataFrame(
        [("1", "A", "B", "S"), ("2", "", "", ""), ("9", "x", "x", "x")],
        "application_number string, abstract string, background string, summary string",
    )
    rows = attached(apps, texts)
    assert rows.columns == ["application_number", "title", "abstract", "summary", "background"]
    found = sorted((r.title, r.abstract, r.summary, r.background) for r in rows.collect())
    assert found == [("a", "A", "S", "B"), ("b", "A", "S", "B"), ("c", "", "", ""), ("d", None, None, None), ("e", None, None, None)]
