import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
from cases import documents, empty, given
from foliosift.llm import language_model as lm
from foliosift.llm.language_model import Pool, lm_scores, model_of, op4_lm_scoring
from pyspark.sql import functions as F


def base_scores(pairs, held):
    words = [(t or "").encode().lower().split() + [None] for _, t in pairs]
    counts = Counter(w for ws, out in zip(words, held, strict=True) if not out for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(ws), sum(counts[w] > 0 for w in ws), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for ws in words
    ]


def check(rows, pairs, held):
    want = base_scores(pairs, held)
    left = sorted(
        ((i, out, *w) for (i, _), out, w in zip(pairs, held, want, strict=True)), key=repr
    )
    right = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows),
        key=repr,
    )
    assert [x[:5] for x in left] == [x[:5] for x in right]
    assert np.allclose([x[5] for x in left], [x[5] for x in right])
    assert all(r.score is not None and math.isfinite(r.score) for r in rows)


def test_given_documents(spark, small):
    pairs = [(r["doc_id"], r["text"]) for r in given(small, "documents")]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs]
    rows = op4_lm_scoring(spark, small).collect()
    check(rows, pairs, held)
    for out in (True, False):  # held-out texts are likelier than by single words
        part = [r for r in rows if r.held_out == out]
        assert sum(r.score for r in part) > sum(r.base_score for r in part)


def test_awkward_rows(spark):
    pairs = [(1, None), (2, ""), (3, "A b a"), (4, "a\x0bb unknown"), (5, "a " * 8000), (6, "É é")]
    pairs += [(3, "A b a"), (3, "other text"), (7, "b rare"), (None, "b")]
    held = [i in (4, None) for i, _ in pairs]
    df = documents(spark, pairs)
    check(lm_scores(df, F.col("doc_id") == 4).collect(), pairs, held)
    assert lm_scores(empty(spark), F.col("doc_id") == 4).count() == 0
    nothing = lm_scores(df, F.lit(True)).collect()
    check(nothing, pairs, [True] * len(pairs))


def test_score_is_the_probability_of_the_words(spark):
    """Against a plain recursion over words, with the start model and words that share classes."""
    choose = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2600)]
    pairs = [(i, " ".join(choose.choices(vocabulary, k=900))) for i in range(12)]
    pairs += [(20, "w1 unknown w2"), (21, "")]
    rows = lm_scores(documents(spark, pairs), F.col("doc_id").isin(3, 20), shares=()).collect()
    words = {i: t.encode().split() for i, t in pairs}
    train = Counter(w for i in words if i not in (3, 20) for w in words[i])
    own = {w: k for k, (_, w) in enumerate(sorted((-n, w) for w, n in train.items())[: lm.OWN_WORDS])}
    totals, distinct = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    for w, n in train.items():
        c = own.get(w, lm.rest_class(w))
        totals[c] += n
        distinct[c] += 1
    totals[lm.END] = 12
    assert len(train) > lm.OWN_WORDS
    start, move, emit = lm.start_model(totals, lm.STATES)
    for row in rows:
        state, want = None, 0.0
        for w in [*words[row.doc_id], None]:
            c = lm.END if w is None else own.get(w, lm.rest_class(w))
            share = 1 if c == lm.END or w in own else (train[w] + 1) / (totals[c] + distinct[c] + 1)
            state = emit[c] * (start if state is None else state @ move)
            want += math.log10(state.sum() * share)
            state = state / state.sum()
        assert math.isclose(row.score, want, rel_tol=1e-9)


def test_forward_is_the_sum_over_paths():
    draw = np.random.default_rng(0)
    model = model_of(draw.random(3), draw.random((3, 3)), draw.random((3, lm.CLASSES)))
    sequences = [np.array(s) for s in ([1, 5, 5, 2], [7], [3, 1], [3, 1])]
    found = Pool(sequences).forward(model)
    start, move, emit = model
    for s, got in zip(sequences, found, strict=True):
        total = 0
        for path in itertools.product(range(3), repeat=len(s)):
            p = start[path[0]] * emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= move[path[t - 1], path[t]] * emit[s[t], path[t]]
            total += p
        assert math.isclose(got, math.log(total))


def test_passes_never_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(lm, "SMOOTH", 1e-9)
    random = np.random.default_rng(2)
    pool = Pool([random.integers(0, 6, random.integers(1, 30)) for _ in range(50)])
    model = model_of(random.random(3), random.random((3, 3)), random.random((3, lm.CLASSES)))
    last = -math.inf
    for _ in range(15):
        starts, moves, emissions, likelihood = pool.counts(model)
        assert likelihood >= last - 1e-6
        assert math.isclose(emissions.sum(), len(pool.tokens))
        assert math.isclose(starts.sum(), 50) and math.isclose(moves.sum(), len(pool.tokens) - 50)
        last, model = likelihood, model_of(starts, moves, emissions)


def test_pools_do_not_change_results():
    random = np.random.default_rng(4)
    model = model_of(random.random(2), random.random((2, 2)), random.random((2, lm.CLASSES)))
    parts = [random.integers(0, 9, n) for n in (5, 1, 9, 5, 2)]
    whole = Pool(parts).counts(model)
    split = [Pool([p]).counts(model) for p in parts]
    for k in range(4):
        assert np.allclose(whole[k], sum(s[k] for s in split))
    assert np.allclose(Pool(parts).forward(model), [Pool([p]).forward(model)[0] for p in parts])


