"""Benchmark decontamination: Wu-Manber search for word windows of benchmark items."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from foliosift.llm.common import MAP_BITS, byte_texts, name_of, row_batches, row_of, with_columns
from foliosift.session import written

# A-Z become a-z, ASCII other than letters and digits becomes a blank, the rest stays.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
    for b in range(256)
)
# Words as ``words_of`` finds them, for texts whose A-Z are not yet folded.
# The marks stand one by one, as the JVM looks single characters up and compares ranges.
WORD = "[^" + "".join(rf"\x{b:02X}" for b in range(128) if not chr(b).isalnum()) + "]+"
WINDOW = 10
BLOCK = 2
# Slots of a shift table, one byte each, and bits that tell which windows there may be. Both
# are as large for any benchmark: 256 KB for each pattern length and 4 MB.
SLOTS, WINDOW_BITS = 1 << 18, 1 << 25


def words_of(data):
    return data.translate(FOLD).split()


def slot_of(words, slots):
    """Slot of a block of words in a shift table."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) % slots


def bit_of(window, bits):
    return xxhash.xxh3_64_intdigest(window, 1) % bits


class Patterns:
    """Search for word sequences of one length.

    ``shift`` tells for the slot of a block of words how far the search may move on: the least
    distance of such a block from the end of any pattern. Where it is 0 the window may be a
    pattern; ``bits`` sorts out most that are none.
    """

    def __init__(self, length, shift, bits):
        self.length, self.block, self.shift, self.bits = length, min(BLOCK, length), shift, bits

    def candidates(self, words):
        """(start, window) of each place where a pattern may be, and of each where one is."""
        m, b, shift, bits = self.length, self.block, self.shift, self.bits
        end, n, slots, size = m, len(words), len(shift), 8 * len(bits)
        while end <= n:
            step = shift[slot_of(words[end - b : end], slots)]
            if step:
                end += step
                continue
            window = b" ".join(words[end - m : end])
            bit = bit_of(window, size)
            if bits[bit >> 3] >> (bit & 7) & 1:
                yield end - m, window
            end += 1


def shifts(windows, slots):
    """(length, slot, shift) of the blocks in windows of words; a slot may come again."""
    for words in windows:
        m, b = len(words), min(BLOCK, len(words))
        for i in range(m - b + 1):
            yield m, slot_of(words[i : i + b], slots), m - b - i


def item_windows(data, window=WINDOW):
    """The windows of an item: all sequences of ``window`` words, or all words of a shorter one."""
    words = words_of(data)
    length = min(window, len(words))
    return [words[i : i + length] for i in range(len(words) - length + 1)] if words else []


def benchmark_windows(benchmark, item, text, window, bits):
    """(window, bit, item) for each distinct window of each item, as a stored table."""

    def cut(batches):
        for batch in row_batches(batches):
            places, found = [], []
            for i, data in enumerate(byte_texts(batch)):
                own = {b" ".join(w) for w in item_windows(data, window)}
                places += [i] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.binary()),
                    pa.array([bit_of(w, bits) for w in found], pa.int64()),
                    batch.column("item").take(pa.array(places, pa.int64())),
                ],
                ["window", "bit", "item"],
            )

    rows = benchmark.select(
        name_of(item).cast("string").alias("item"), name_of(text).alias("text")
    ).filter("item is not null and text is not null")
    return written(rows.mapInArrow(cut, "window binary, bit long, item string").distinct(), "windows")


def search_tables(windows, window, slots, bits):
    """Shift table of each pattern length, and the bits of all windows, built by the tasks.

    The driver gets the least shift of each slot in use, at most ``slots`` for each of at most
    ``window`` lengths, and the bits, whatever the benchmark holds.
    """

    def least_shifts(batches):
        least = {}
        for batch in row_batches(batches):
            for m, slot, shift in shifts((w.split(b" ") for w in byte_texts(batch, "window")), slots):
                least[m, slot] = min(shift, least.get((m, slot), shift))
        rows = [(m, slot, shift) for (m, slot), shift in least.items()]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("length", "slot", "shift"), r, strict=True)) for r in rows],
            pa.schema([("length", pa.int32()), ("slot", pa.int32()), ("shift", pa.int32())]),
        )

    found = windows.select("window").mapInArrow(least_shifts, "length int, slot int, shift int")
    found = found.groupBy("length", "slot").agg(F.min("shift").alias("shift")).toArrow()
    columns = [found.column(c).to_numpy() for c in ("length", "slot", "shift")]
    present = bytearray(max(bits, MAP_BITS) // 8)
    maps = windows.groupBy(F.expr(f"bit div {MAP_BITS}").alias("map"))
    for row in maps.agg(F.bitmap_construct_agg(F.expr(f"bit % {MAP_BITS}")).alias("bits")).collect():
        at = row["map"] * MAP_BITS // 8
        present[at : at + MAP_BITS // 8] = row["bits"]
    present, tables = bytes(present[: bits // 8]), []
    for m in range(1, window + 1):
        own = columns[0] == m
        if own.any():
            shift = np.full(slots, m - min(BLOCK, m) + 1, np.uint8)
            shift[columns[1][own]] = columns[2][own]
            tables.append(Patterns(m, shift.tobytes(), present))
    return tables


def contamination(
    docs, benchmark, text="text", item="item_id", item_text="text", window=WINDOW, slots=SLOTS, bits=WINDOW_BITS
):
    """``docs`` with ``n_words``, ``n_hit``, ``hits``, ``items`` and ``contaminated``.

    Windows are ``window`` consecutive words of an item, or all words of a shorter one.
    ``hits`` are the joined (start, end) ranges of document words inside an occurrence,
    ``items`` the ids of the items found, as sorted texts. The windows of the benchmark are a
    stored table. What is broadcast, the shift tables and bits by which the search skips
    impossible positions, has a fixed size; a larger benchmark only lets more positions
    through. Windows at those positions meet the table by equality, suffix and all, so the
    result is exact. A text that many documents share is looked up once.

    A null, empty or wordless text has no words and is clean; items without id or words
    find nothing; repeated rows of either table change no other result. An empty benchmark
    leaves all clean, an empty document table is empty. Other columns stay, also where
    their names clash with the working columns; the five named ones are replaced. ``window`` is
    255 at most.
    """
    windows = benchmark_windows(benchmark, item, item_text, window, bits)
    tables = docs.sparkSession.sparkContext.broadcast(search_tables(windows, window, slots, bits))
    content = name_of(text)
    base = docs.select(
        row_of(docs),
        content.alias("text"),
        F.xxhash64(content).alias("h1"),
        F.xxhash64(F.lit(1), content).alias("h2"),
    )
    asked = base.select("h1", "h2", "text").mapInArrow(
        scan_with(tables), "h1 long, h2 long, start long, end long, window binary"
    )
    asked = written(asked.distinct(), "asked")
    found = asked.join(windows.select("window", "item"), "window").groupBy("h1", "h2")
    found = found.agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("ranges"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )
    kind = "array<struct<start:bigint,end:bigint>>"
    found = found.mapInArrow(join_ranges, f"f1 long, f2 long, hits {kind}, items array<string>")
    df = base.join(written(found, "hits"), (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left")
    hits = F.coalesce("hits", F.array().cast(kind))
    n_hit = F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    return with_columns(
        df,
        {
            "n_words": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"),
            "n_hit": n_hit,
            "hits": hits,
            "items": F.coalesce("items", F.array().cast("array<string>")),
            "contaminated": F.size(hits) > 0,
        },
        docs.columns,
    )


def joined(ranges):
    """Sorted ranges with those that touch made one."""
    out = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def join_ranges(batches):
    """Ranges of a document that touch or overlap, made one."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        ranges = (
            [{"start": a, "end": b} for a, b in joined((r["start"], r["end"]) for r in found)]
            for found in batch.column("ranges").to_pylist()
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("h1"), batch.column("h2"), pa.array(list(ranges), kind), batch.column("items")],
            ["f1", "f2", "hits", "items"],
        )


def scan_with(tables):
    """Places of each text where a pattern may be."""

    def scan(batches):
        for batch in row_batches(batches):
            places, spans, windows = [], [], []
            for i, data in enumerate(byte_texts(batch)):
                words = words_of(data or b"")
                for patterns in tables.value:
                    for start, window in patterns.candidates(words):
                        places.append(i)
                        spans.append((start, start + patterns.length))
                        windows.append(window)
            at = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("h1").take(at),
                    batch.column("h2").take(at),
                    pa.array([s for s, _ in spans], pa.int64()),
                    pa.array([e for _, e in spans], pa.int64()),
                    pa.array(windows, pa.binary()),
                ],
                ["h1", "h2", "start", "end", "window"],
            )

    return scan


def op7_decontamination(spark, sf_dir):
    """Benchmark hits of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
