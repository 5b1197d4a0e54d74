import hashlib
import random
import re

import pytest
from cases import documents, empty, given, rows
from foliosift.llm import decontamination as D
from foliosift.llm.decontamination import contamination, op7_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(text, items):
    mine, hit, names = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        n = min(10, len(theirs))
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(mine) - n + 1):
            if tuple(mine[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(str(item))
    return len(mine), len(hit), sorted(names)


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("collisions", [False, True])
def test_awkward_rows(spark, collisions):
    choose = random.Random(5)
    text = lambda n: " ".join(choose.choices("ab cd ef gh".split(), k=n))
    items = [(n, text(choose.randint(1, 14))) for n in range(12)]
    items += [(20, None), (21, "..."), (22, "É a,b"), (3, text(30)), (None, "ab"), (30, items[0][1])]
    pairs = [(n, text(choose.randint(0, 60))) for n in range(40)]
    pairs += [(50, None), (51, ""), (52, "É-A!b"), (53, "é a b"), (54, text(5000))]
    pairs += [pairs[0], (None, pairs[1][1])]
    # With few slots and bits nearly every block and window shares them with others.
    sizes = {"slots": 2, "bits": 16} if collisions else {}
    got = contamination(documents(spark, pairs), items_table(spark, items), **sizes)
    known = [i for i in items if i[0] is not None]
    want = [(i, *plain(t, known)) for i, t in pairs]
    want = sorted(((i, n, h, names, h > 0) for i, n, h, names in want), key=repr)
    assert rows(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    assert {r.own for r in got.select("own").collect()} == {7}


def test_shifts_pass_over_other_words(monkeypatch):
    words = b"a b c d e f g h i j".split()
    shift, bits = bytearray([9]) * D.SLOTS, bytearray(D.WINDOW_BITS // 8)
    for m, slot, step in D.shifts([words], D.SLOTS):
        assert m == 10
        shift[slot] = min(step, shift[slot])
    bit = D.bit_of(b" ".join(words), D.WINDOW_BITS)
    bits[bit >> 3] |= 1 << (bit & 7)
    assert shift[D.slot_of([b"i", b"j"], D.SLOTS)] == 0 and shift[D.slot_of([b"a", b"b"], D.SLOTS)] == 8
    seen, slot_of = [], D.slot_of
    monkeypatch.setattr(D, "slot_of", lambda block, slots: seen.append(block) or slot_of(block, slots))
    table = D.Patterns(10, bytes(shift), bytes(bits))
    assert list(table.candidates([b"x"] * 900)) == [] and len(seen) <= 100
    assert list(table.candidates([b"x"] * 33 + words + [b"y"] * 7)) == [(33, b" ".join(words))]


def test_search_tables_have_a_fixed_size(spark):
    items = [(i, " ".join(f"w{(i * 37 + k) % 5000}" for k in range(40))) for i in range(2000)]
    windows = D.benchmark_windows(items_table(spark, items), "item_id", "text", 10, D.WINDOW_BITS)
    (table,) = D.search_tables(windows, 10, D.SLOTS, D.WINDOW_BITS)
    assert len(table.shift) == D.SLOTS and len(table.bits) == D.WINDOW_BITS // 8
    for row in windows.limit(200).collect():
        words = bytes(row.window).split()
        assert table.shift[D.slot_of(words[-2:], D.SLOTS)] == 0
        assert [w for _, w in table.candidates(words)] == [bytes(row.window)]


def test_empty_tables(spark):
    one = documents(spark, [(1, "a b")])
    assert contamination(empty(spark), items_table(spark, [(1, "a")])).count() == 0
    got = contamination(one, items_table(spark, [])).first()
    assert (got.n_words, got.n_hit, got["items"], got.contaminated) == (2, 0, [], False)


def test_given_documents(spark, small):
    items = [(r["item_id"], r["text"]) for r in given(small, "benchmark")]
    want = []
    for r in given(small, "documents"):
        n, hit, names = plain(r["text"], items)
        sign = hashlib.sha256(",".join(names).encode()).hexdigest()
        want.append((r["doc_id"], n, hit, len(names), sign, hit > 0))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = rows(op7_decontamination(spark, small), *names)
    assert got == sorted(want, key=repr) and any(w[-1] for w in want)
