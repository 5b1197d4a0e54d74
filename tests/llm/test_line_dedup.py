import hashlib
import re

from cases import documents, empty, given, rows
from foliosift.llm.line_dedup import dedup_lines, op1_line_dedup

BLANK = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return BLANK.sub("", line).translate(LOWER)


def plain(pairs):
    holders = {}
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(i)
    out = []
    for i, text in pairs:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if i is None or len(holders.get(key_of(x), ())) < 2 or min(holders[key_of(x)]) == i
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    line = "A line that REPEATS"
    pairs = [
        (1, f"{line}\nown text here"),
        (2, f"\t{line.lower()} \x0b\nother\n\n"),
        (3, None),
        (4, ""),
        (5, f"{line}\n{line}"),
        (5, f"{line}\nsecond text of five"),
        (5, f"{line}\n{line}"),
        (None, line),
        (6, "short\nshort"),
        (7, "short"),
        (8, "ÄÖÜäöüßßß!\nx"),
        (9, "ÄÖÜäöüßßß!"),
        (10, "äÖÜäöüßßß!"),
        (11, "\n".join(f"{line} {n}" for n in range(5000))),
        (12, "\n".join(f"{line} {n}" for n in range(0, 5000, 2))),
    ]
    got = dedup_lines(documents(spark, pairs))
    assert rows(got, "doc_id", "n_lines", "n_dropped", "text") == plain(pairs)
    assert got.columns == [*documents(spark, pairs).columns, "n_lines", "n_dropped"]
    assert {r.own for r in got.select("own").collect()} == {7}


def test_threshold_and_empty(spark):
    pairs = [(i, "the same long line") for i in range(3)]
    assert {r.n_dropped for r in dedup_lines(documents(spark, pairs), max_docs=3).collect()} == {0}
    assert dedup_lines(empty(spark)).count() == 0


def test_given_documents(spark, small):
    pairs = [(r["doc_id"], r["text"]) for r in given(small, "documents")]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(pairs)]
    got = op1_line_dedup(spark, small)
    assert rows(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
