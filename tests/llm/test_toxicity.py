import random

import numpy as np
import pytest
from cases import documents, empty, given
from foliosift.llm import toxicity as X
from foliosift.llm.toxicity import fitted_chain, op9_toxicity, toxicity
from pyspark.sql import functions as F

GOOD = "the garden was calm and green while birds sang over water stones paths trees".split()
BAD = "vile scum trash loser".split()
SCHEMA = "doc_id long, quality int, toxic int"


def texts(n, seed=1):
    """(doc_id, text, quality, toxic): toxic texts hold words of their own, poor ones repeat."""
    choose = random.Random(seed)
    out = []
    for i in range(n):
        toxic, poor = i % 4 == 0, i % 3 == 0
        words = [choose.choice(GOOD) for _ in range(choose.randint(20, 60))]
        if poor:
            words += ["junk"] * 5
        if toxic:
            words[3:3] = [choose.choice(BAD) for _ in range(3)]
        out.append((i, " ".join(words), int(not poor), int(toxic)))
    return out


def tables(spark, rows):
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows], SCHEMA)
    return documents(spark, [r[:2] for r in rows]), labels


def plain_loss(x, y, rounds=6000):
    """Least loss of a dense logistic regression with equal label weights, by plain steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for _ in range(rounds):
        g = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        w -= 0.05 * (x.T @ g + X.REGULARISATION * w)
        b -= 0.05 * g.sum()
    z = x @ w + b
    return weight @ (np.logaddexp(0, z) - y * z) + X.REGULARISATION / 2 * w @ w


def test_fit_is_a_minimum():
    random_ = np.random.default_rng(1)
    features = [np.sort(random_.choice(50, 8, replace=False)).astype(np.int32) for _ in range(300)]
    y = np.array([float(f[0] < 4) for f in features])
    rows = X.Rows(features, random_.random((300, 1)))
    scale = X.evidence(rows, y)
    w = X.fitted(rows, y)
    z = rows.times(w)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    inner = np.divide(w, scale, out=np.zeros_like(w), where=scale != 0)[:-1]
    ours = weight @ (np.logaddexp(0, z) - y * z) + X.REGULARISATION / 2 * inner @ inner
    x = np.zeros((300, 50 + rows.dense.shape[1]))
    for i, f in enumerate(features):
        x[i, f] = scale[f]
    x[:, 50:] = rows.dense
    assert ours <= plain_loss(x, y) + 1e-3
    for i in (0, 17, 299):
        assert X.probability(w, features[i], rows.dense[i, 2:]) == pytest.approx(X.logistic(z)[i])


def test_out_of_fold_rows_are_unseen():
    """A fold whose labels are turned round is judged by the others, so it is judged wrongly."""
    import pyarrow as pa

    n = 90
    fold = np.arange(n) % 3
    truth = (np.arange(n) // 3) % 2
    label = np.where(fold == 1, 1 - truth, truth).astype(float)
    table = pa.table({
        "model": [1] * n, "key": list(range(n)), "fold": fold, "y0": label,
        "features": pa.array([[int(t)] for t in truth], pa.list_(pa.int32())),
        "earlier": pa.array([[]] * n, pa.list_(pa.float64())),
    })
    found = X.fit_model("y0", pa.int64())(table)
    assert sorted(found.column("key").to_pylist()) == [i for i in range(n) if i % 3 == 1]
    for key, p in zip(found.column("key").to_pylist(), found.column("p").to_pylist(), strict=True):
        assert (p > 0.5) == (truth[key] == 1) != (label[key] == 1)


def test_toxic_documents_are_rejected(spark):
    rows = texts(400)
    docs, labels = tables(spark, rows[:250])
    unseen = documents(spark, [r[:2] for r in rows])
    found = {r.doc_id: r for r in toxicity(unseen, labels).collect()}
    wrong = [i for i, _, _, t in rows if found[i].rejected != bool(t)]
    assert len(wrong) <= 4
    chain = fitted_chain(docs, labels)
    assert [len(w) for w in chain] == [X.BUCKETS + 3, X.BUCKETS + 4]
    for i, text, _, _ in rows[:30]:
        f = X.Features().of(text.encode())
        first = X.probability(chain[0], f, [])
        assert found[i].p_quality == pytest.approx(first)
        assert found[i].p_toxic == pytest.approx(X.probability(chain[1], f, [first]))


def test_awkward_rows(spark):
    rows = texts(120)
    _, labels = tables(spark, rows)
    more = [(None, "calm garden"), (500, None), (501, ""), (502, "vile scum trash loser " * 10_000), (7, rows[7][1]), (7, "other")]
    docs = documents(spark, [r[:2] for r in rows] + more)
    labels = labels.unionByName(labels).union(
        spark.createDataFrame([(8, None, 1), (None, 1, 1), (9, 0, None), (900, 1, 1)], SCHEMA)
    )
    found = toxicity(docs, labels)
    assert found.columns == [*docs.columns, "p_quality", "p_toxic", "rejected"]
    assert found.count() == docs.count()
    assert found.filter("text is null or text = ''").select("p_toxic").distinct().count() == 1
    assert found.filter("doc_id = 502").first().rejected
    assert [tuple(r) for r in toxicity(docs, labels).orderBy("doc_id", "text").collect()] == [
        tuple(r) for r in found.orderBy("doc_id", "text").collect()
    ]


def test_few_labels_and_empty_tables(spark):
    docs, labels = tables(spark, texts(12))
    assert toxicity(empty(spark), labels).count() == 0
    for none in (labels.limit(0), labels.selectExpr("doc_id + 1000 as doc_id", "quality", "toxic")):
        assert {(r.p_toxic < 0.01, r.rejected) for r in toxicity(docs, none).collect()} == {(True, False)}
    one = labels.selectExpr("doc_id", "1 as quality", "0 as toxic")
    assert {(r.p_quality > 0.99, r.rejected) for r in toxicity(docs, one).collect()} == {(True, False)}


def test_held_out_accuracy(spark):
    """Half of the given labels are enough for the other half."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = labels.filter("hash(doc_id) % 2 = 0")
    rest = labels.filter("hash(doc_id) % 2 <> 0").select("doc_id", "toxic")
    hits = toxicity(docs, half).join(rest, "doc_id").groupBy("toxic").agg(F.avg(F.col("rejected").cast("int")).alias("r"))
    rate = {row.toxic: row.r for row in hits.collect()}
    assert rate[1] >= 0.8 and rate[0] <= 0.01


def test_every_document_has_a_verdict(spark, small):
    found = op9_toxicity(spark, small)
    assert found.columns == ["doc_id", "p_quality", "p_toxic", "rejected"]
    assert found.count() == len(given(small, "documents"))
