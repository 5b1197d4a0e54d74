import hashlib
import zlib

from cases import given, rows
from foliosift.llm.merkle import folded, merkle_manifest, op11_merkle_manifest, proof_text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, path string, `group` int"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(leaves):
    """Top of a tree, and the siblings (before, after) of each leaf on each level."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for p, i in zip(paths, at, strict=True):
            start = i - i % 16
            p.append(("".join(leaves[start:i]), "".join(leaves[i + 1 : start + 16])))
        leaves = [digest(*leaves[i : i + 16]) for i in range(0, len(leaves), 16)]
        at = [i // 16 for i in at]
    return leaves[0] if leaves else None, paths


def plain(table):
    """(doc_id, leaf, subroot, root, siblings) of each row, by a model on lists."""
    sources = {}
    for row in table:
        sources.setdefault(row["source"], []).append((row["doc_id"], leaf(row)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        found = sorted(sources[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = (found, *tree([d for _, d in found]))
    root, upper = tree([trees[s][1] for s in order])
    for s, above in zip(order, upper, strict=True):
        found, subroot, paths = trees[s]
        for (name, d), path in zip(found, paths, strict=True):
            yield name, d, subroot, root, [*path, *above]


def test_awkward_rows(spark):
    table = [(i, f"Téxt {i}", "en", "hot", i, 1, "p", 2) for i in range(5000)]  # three rounds of blocks
    table += [(i, None if i % 3 else "", None, None, None, 1, "p", 2) for i in range(100, 117)]
    table += [(None, "x" * 50_000, "en", "one", 5, 1, None, 2)]
    table += [(7, "same", "en", "same", 4, 1, "p", 2)] * 30 + [(7, "other", "en", "same", 4, 1, "p", 2)]
    table += [(3, "lone", "en", f"s{n}", 4, 1, "p", 2) for n in range(40)]
    docs = spark.createDataFrame(table, SCHEMA).repartition(5)
    got = merkle_manifest(docs, carried=["path"]).collect()
    want = list(plain([dict(zip(docs.columns, row, strict=True)) for row in table]))
    path = lambda p: tuple((s["before"], s["after"]) for s in p)
    ours = sorted(((r.doc_id, r.leaf, r.subroot, r.root, path(r[6])) for r in got), key=repr)
    assert ours == sorted(((*w[:4], tuple(w[4])) for w in want), key=repr)
    assert len({r.root for r in got}) == 1


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "a", "en", "s", 1, 1, "p", 2)], SCHEMA)
    row = merkle_manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert merkle_manifest(one.limit(0)).count() == 0


def test_any_change_breaks_the_fold(spark):
    docs = spark.createDataFrame([(i, "Some Text", "en", f"s{i % 3}", 9, 1, "p", 2) for i in range(60)], SCHEMA)
    found = merkle_manifest(docs)
    right = found.select((folded("leaf", found.path) == found.root).alias("same"))
    assert {r.same for r in right.collect()} == {True}
    wrong = found.select((folded("subroot", found.path) == found.root).alias("same"))
    assert {r.same for r in wrong.collect()} == {False}
    assert {len(r.t) % 64 for r in found.select(proof_text(found.path).alias("t")).collect()} == {0}


def test_given_documents(spark, small):
    table = given(small, "documents")
    by_id = {r["doc_id"]: r for r in table}
    want = []
    for name, d, subroot, root, path in plain(table):
        node = d
        if zlib.crc32(str(name).encode()) % 5 == 0:
            text = by_id[name]["text"]
            low = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(by_id[name] | {"text": low})
        for before, after in path:
            node = digest(before, node, after)
        proof = digest(*(before + after for before, after in path))
        want.append((name, d, subroot, root, proof, node, node == root))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = rows(op11_merkle_manifest(spark, small), *names)
    assert got == sorted(want, key=repr)
    assert {row[-1] for row in got} == {True, False}
