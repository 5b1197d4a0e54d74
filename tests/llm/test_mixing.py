import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from cases import given, rows
from foliosift.llm.mixing import mixed_documents, mixture, op12_source_mix, with_targets

SCHEMA = "doc_id long, source string, text string, size string, finish int, turn int, rank int"


def targets(sizes, most=3):
    """Exact targets by resharing what full sources leave, one round after the other."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        spare = total - sum(most * sizes[s] for s in full)
        share = {s: Fraction(spare * weight[s], sum(weight[r] for r in rest)) for s in rest}
        over = {s for s in rest if most * sizes[s] < share[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share[s] for s in order}
        full |= over


def plain(table):
    """(doc_id, size, source_size, target, taken) by a model on lists."""
    docs = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in table]
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    goal = targets(sizes)
    rank = {s: i for i, s in enumerate(goal)}
    turn = lambda i: hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()
    copies, seen = [], Counter()
    for d, (i, s, n) in sorted(enumerate(docs), key=lambda x: (turn(x[1][0]), x[1][0] or 0, x[1][2])):
        seen[s] += n
        for e in range(3):
            passed = e * sizes[s] + seen[s]
            if e * sizes[s] < goal[s] and n:
                copies.append((Fraction(passed) / goal[s], rank[s], passed, n, d))
    room, taken = sum(sizes.values()), Counter()
    for *_, n, d in sorted(copies):
        room -= n
        if room < 0:
            break
        taken[d] += n
    return [(i, n, sizes[s], float(goal[s]), taken[d]) for d, (i, s, n) in enumerate(docs)]


NAMES = ["doc_id", "size", "source_size", "target", "taken"]


def frame(spark, table):
    return spark.createDataFrame([(*row, "x", 1, 2, 3) for row in table], SCHEMA).repartition(3)


def test_awkward_rows(spark):
    table = [(i, "hot", "word " * (i % 50)) for i in range(600)]
    table += [(i, f"s{i % 5}", "a\tb\x0bc d " * (i % 7)) for i in range(600, 700)]
    table += [(None, None, "one two"), (900, None, None), (901, "", ""), (902, "nothing", None)]
    table += [(903, "small", "x"), (904, "long", "y " * 20_000)] + [(905, "copies", "z z z")] * 40
    table += [(906, "Über", "a b"), (907, "über", "a b"), (908, "\U0001f600", "a b")]
    got = rows(mixture(frame(spark, table)), *NAMES)
    want = sorted(plain(table), key=repr)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    assert all(r[4] <= 3 * r[1] for r in got)


def test_empty_tables_and_texts(spark):
    assert mixture(frame(spark, [(1, "a", "b")]).limit(0)).count() == 0
    got = rows(mixture(frame(spark, [(1, "a", None), (2, None, " ")])), *NAMES)
    assert got == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_sources_come_near_their_targets(spark, small):
    got = mixture(frame(spark, [(r["doc_id"], r["source"], r["text"]) for r in given(small, "documents")]))
    sums = got.groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    for row in sums:
        assert abs(row["sum(taken)"] - row["max(target)"]) <= row["max(size)"]


def test_targets_of_many_rounds(spark):
    sizes = {f"s{i:02}": 4**i for i in range(12)}
    table = [(s, n, i % 3 + 1) for i, (s, n) in enumerate(sizes.items())]
    got = with_targets(spark.createDataFrame(table, "source string, size long, weight long"), sum(sizes.values()))
    want = {s: float(t) for s, t in targets(sizes).items()}
    assert {r.source: r.target for r in got.collect()} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_mixed_documents(spark):
    table = [(i, f"s{i % 4}", f"text number {i} " * (1 + i % 4)) for i in range(200)] + [(1, "s1", "same same")] * 5
    docs = frame(spark, table)
    mix = mixture(docs)
    found = mixed_documents(docs, mix).collect()
    count = Counter((r.doc_id, r.source, r.text) for r in found)
    want = Counter()
    for r in mix.collect():
        want[(r.doc_id, r.source, r.size)] += r.copies
    assert Counter({(i, s, len(t.split())): n for (i, s, t), n in count.items()}) == +want
    assert [r.source for r in found] and docs.columns == [c for c in found[0].asDict() if c != "finish"][:4] + ["finish", "turn", "rank"]


def test_given_documents(spark, small):
    table = [(r["doc_id"], r["source"], r["text"]) for r in given(small, "documents")]
    want = sorted(plain(table), key=repr)
    for _ in range(2):
        got = rows(op12_source_mix(spark, small), *NAMES)
        assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
