import corpus_pipeline
from cases import given
from corpus_pipeline import STAGES, run
from foliosift.llm.toxicity import toxicity
from test_decontamination import plain as plain_hits
from test_line_dedup import plain as plain_lines
from test_near_dedup import plain as plain_groups
from test_packing import checked


def stages_by_hand(pairs, rejected, items):
    """(doc_id, text) after all filtering stages, by the models of the operators' own tests."""
    pairs = [(i, t) for i, t in pairs if i not in rejected]
    pairs = [(i, t) for i, _, _, t in plain_lines(pairs)]
    kept = {i for i, _, _, own in plain_groups(pairs, corpus_pipeline.NEAR_PERCENT) if own}
    return [(i, t) for i, t in pairs if i in kept and not plain_hits(t, items)[1]]


def test_run_equals_its_stages_by_hand(spark, small):
    pairs = [(r["doc_id"], r["text"]) for r in given(small, "documents")]
    items = [(r["item_id"], r["text"]) for r in given(small, "benchmark")]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    verdicts = toxicity(docs, labels).filter("rejected").select("doc_id").collect()
    want = stages_by_hand(pairs, {r.doc_id for r in verdicts}, items)
    assert 0 < len(want) < len(pairs)
    assert checked(run(spark, small).collect(), want) < 0.01


def test_stages_keep_columns_and_awkward_rows(spark, small):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "no id at all", "en", "s", 1),
            (4, "same text of some words here", "en", "s", 2), (4, "same text of some words here", "en", "s", 2),
            (5, "long " * 30_000, "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for name, stage in STAGES[:-1]:
            found = stage(spark, table, small)
            assert found.dtypes == docs.dtypes, name
            if table is docs:
                assert {r.doc_id for r in found.collect()} == {1, 2, None, 4, 5}, name
        pieces = STAGES[-1][1](spark, table, small)
        assert {r.doc_id for r in pieces.collect()} == ({1, 2, None, 4, 5} if table is docs else set())


def test_stages_are_as_dealt():
    assert [name for name, _ in STAGES] == [
        "toxicity", "line dedup", "near dedup", "decontamination", "packing",
    ]
