import random
import re
from collections import Counter

from cases import documents, empty, given
from foliosift.llm.quality import op8_quality_rules, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit |= set(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(hit), failed


def check(got, pairs):
    left = sorted(((i, *plain(t)) for i, t in pairs), key=repr)
    assert left == sorted((tuple(r)[:6] + (r.base_failed,) for r in got), key=repr)
    assert all(not r.kept for r in got if r.base_failed)


def test_given_documents(spark, small):
    got = op8_quality_rules(spark, small).drop("llr").collect()
    check(got, [(r["doc_id"], r["text"]) for r in given(small, "documents")])
    good = {r["doc_id"] for r in given(small, "labels") if r["quality"] == 1}
    bad = {r["doc_id"] for r in given(small, "labels") if r["quality"] == 0}
    sound = [r for r in got if not r.base_failed]
    assert sum(r.kept for r in sound if r.doc_id in good) >= 0.97 * sum(r.doc_id in good for r in sound)
    assert sum(r.kept for r in sound if r.doc_id in bad) <= 0.1 * max(10, sum(r.doc_id in bad for r in sound))


def test_awkward_rows(spark):
    pairs = [(1, None), (2, ""), (3, "é #\n\né #\n é #"), (4, "a b c d e f g h " * 3), (None, "x " * 30)]
    pairs += [(5, "w " * 5000), (5, "w " * 5000), (6, "\x85 a\x1cb")]
    labels = spark.createDataFrame([(1, 1), (4, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    check(quality(documents(spark, pairs), labels).drop("llr").collect(), pairs)
    check(quality(documents(spark, pairs), labels.limit(0)).drop("llr").collect(), pairs)
    assert quality(empty(spark), labels).count() == 0


def test_one_odd_trusted_row_does_not_set_the_threshold(spark):
    choose = random.Random(2)
    make = lambda letters: " ".join("".join(choose.choices(letters, k=5)) for _ in range(60))
    good, bad = [make("abcdefg") for _ in range(60)], [make("qrstuvwxyz") for _ in range(40)]
    pairs = list(enumerate([*good, *bad, "qrstu " * 30]))
    # Two odd rows are trusted: one like the bad, one that the rules reject.
    trusted = [*range(60), 60, 100]
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    kept = {r.doc_id for r in quality(documents(spark, pairs), labels).collect() if r.kept}
    assert kept == set(range(60))
