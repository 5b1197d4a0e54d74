import math
import random

import numpy as np
import pytest
from cases import given
from foliosift.llm import hard_negatives as H
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, id int, anchor string, score int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(table):
    """All results by sorting all rows for each anchor; repeated anchors count once."""
    rows = []
    for i, vector, label in table:
        if None in (i, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        rows.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole))
    out = []
    for i, label, vector in sorted({r for r in rows if r[0] % 100 == 0}):
        score = [(-sum(x * y for x, y in zip(vector, r[2], strict=False)), r[0], r[1]) for r in rows]
        score.sort()
        for p, j, _ in [s for s in score if s[2] == label and s[1] != i][:5]:
            inside = [s for s in score if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(i, j, n + 1, k, -p, -s) for n, (s, k, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, table, **options):
    rows = spark.createDataFrame([(*r, 1, "a", 2) for r in table], SCHEMA).repartition(5)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return H.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label, **options)


def found(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


def vectors(n, seed, width=6, spread=0.3):
    choose = random.Random(seed)
    return [(i, [choose.uniform(-spread, 1) for _ in range(width)], choose.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 3])
def test_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(H, "ANCHOR_BLOCK", block)
    table = vectors(1200, 1)
    table += [(2000 + i, table[100][1], i % 2) for i in range(400)]  # a third of copies: ties
    table += [(3000, None, 1), (3001, [0.1, None], 1), (3002, [float("nan")] * 6, 1), (3003, [float("inf")], 1)]
    table += [(None, [0.5] * 6, 1), (3100, [0.5] * 6, None), (3200, [], 1), (3300, [0.5] * 3, 2), (3301, [0.5] * 9, 2)]
    table += [(3400, [-0.5] * 6, 1), (3500, [0.0] * 6, 0), table[200], table[200], table[301], table[301]]
    table += [(3600, [0.9] * 6, 8), (3601, [0.8] * 6, 8), (3700, [0.7] * 6, 9)]  # few of a label, one of a label
    assert found(mined(spark, table)) == plain(table)


def test_windows_that_overlap_and_ties(spark):
    table = [(i, [1.0, (i % 12) / 64], i % 3) for i in range(1, 400)] + [(100 * i, [1.0, 1.0], i % 3) for i in range(1, 5)]
    got = plain(table)
    assert found(mined(spark, table)) == got and len(got) > 50


def test_held_candidates_are_bounded(monkeypatch):
    monkeypatch.setattr(H, "HELD", 50)
    random_ = np.random.default_rng(3)
    best, every = H.Best(4, 5), []
    for _ in range(200):
        slots, score, ids = random_.integers(0, 4, 30), random_.integers(0, 40, 30), random_.integers(0, 10**6, 30)
        best.add(slots, score, ids)
        every += zip(slots.tolist(), (-score).tolist(), ids.tolist(), strict=True)
        assert best.size <= 80
    want = [t for s in range(4) for t in sorted(e for e in every if e[0] == s)[:5]]
    slots, score, ids = best.best()
    assert list(zip(slots.tolist(), (-score).tolist(), ids.tolist(), strict=True)) == want


def test_large_components(spark):
    wide = [(100, [2.0**20] * 4, 1), (101, [2.0**20] * 4, 1), (102, [2.0**20 * 0.9] * 4, 2)]
    got = found(mined(spark, wide))
    assert got == plain(wide) and got[0][4] == 4 * 2**56
    with pytest.raises(Exception, match="64 bits"):
        found(mined(spark, [(100, [2.0**40] * 4, 1), (101, [2.0**40] * 4, 1)]))


def test_empty_tables(spark):
    table = vectors(250, 2)
    assert mined(spark, [r for r in table if r[0] % 100]).count() == 0
    assert mined(spark, table[:1]).count() == 0
    rows = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(rows, F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(ValueError):
        H.hard_negatives(rows, F.lit(True), low=100, high=100)


def test_given_vectors(spark, small):
    table = [(r["vec_id"], r["embedding"], r["label"]) for r in given(small, "embeddings")]
    got = found(H.op13_hard_negatives(spark, small))
    assert got == plain(table) and got
