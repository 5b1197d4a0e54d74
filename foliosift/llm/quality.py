"""Quality rules: repetition rules and a likelihood ratio of hashed n-grams."""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foliosift.llm.common import byte_texts, code_points, name_of, row_batches, texts
from foliosift.session import written

SYMBOLS = re.compile(rb"[#*$%&|<>]")
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 0.30
GRAM, BUCKETS = 4, 1 << 16
# Share of the trusted rows that pass the rules and may fail the threshold.
TRUSTED_LOSS = 0.01
# Steps of a unit of the mean log ratio that the threshold is set by.
STEPS = 10_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def windows_hashed(values, width):
    """Fingerprints of all windows of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * MIX + values[i : i + n]
        out ^= out >> np.uint64(29)
    return out


def repeated_words(words, width=REPEAT_WINDOW):
    """Words inside windows of ``width`` words that the text holds twice or more."""
    ids = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    hashed = windows_hashed(numbers, width)
    if not len(hashed):
        return 0
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(hashed), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(twice)] += twice
    edges[width:] -= twice
    return int((np.cumsum(edges) > 0).sum())


def rules(data):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split()]
    return (
        len(words),
        code_points(b"".join(words)),
        len(SYMBOLS.findall(data)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def grams(data, width=GRAM, buckets=BUCKETS):
    """Bucket of each n-gram of the bytes of a text; a shorter text is one n-gram."""
    if len(data) < width:
        return np.array([zlib.crc32(data) % buckets] if data else [], np.int64)
    codes = np.frombuffer(data, np.uint8).astype(np.uint64)
    return (windows_hashed(codes, width) * MIX >> np.uint64(48)).astype(np.int64) % buckets


def trusted_keys(labels, key, label):
    """Keys of the trusted rows."""
    chosen = labels.filter((name_of(label) == 1) & name_of(key).isNotNull())
    return chosen.select(name_of(key).alias("key")).distinct()


def gram_counts(rows, buckets):
    """Counts of buckets over all ``rows``.

    Each task adds up its rows first, so it sends one number for each bucket.
    """

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in row_batches(batches):
            for data in byte_texts(batch):
                total += np.bincount(grams(data, buckets=buckets), minlength=buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"]
        )

    counts = rows.select("text").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one a bucket
        out[row["bucket"]] = row["n"]
    return out


def lower_bound(scores, loss):
    """Bound that a share ``loss`` of the numbers ``llr`` lies below, in 1 / STEPS.

    One standard error of that count may lie below as well, so that a single odd row among
    few does not set the bound; among many it makes no difference.

    The driver gets one count for each step in use, whose number the range of log ratios
    bounds, and the same numbers give the same bound.
    """
    step = F.floor(F.col("llr") * STEPS).alias("step")
    counts = scores.filter("llr is not null").groupBy(step).count().collect()
    total = sum(row["count"] for row in counts)
    before = int(total * loss + (total * loss) ** 0.5)
    for row in sorted(counts):
        if before < row["count"]:
            return row["step"] / STEPS
        before -= row["count"]
    return float("-inf")


def log_ratio(counts):
    """log p(target) - log p(raw) of each bucket, both smoothed by one."""
    p = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def quality(
    docs, labels, key="doc_id", text="text", label="quality", trusted_loss=TRUSTED_LOSS,
    buckets=BUCKETS,
):
    """Rules and the n-gram verdict for each document.

    Two multinomials over hashed n-grams, one of trusted rows and one of all rows, give
    each document its mean log ratio ``llr``. The raw counts cover every document, the
    trusted ones every document that is labelled so, found by a join. ``kept`` is false if
    a rule fails or ``llr`` lies below the ``trusted_loss`` quantile of the trusted rows
    that pass the rules, with the standard error of ``lower_bound``: equal input, equal verdict. Rules
    and ratios are stored once; the driver gets counts of buckets and of steps of ``llr``.

    A null or empty text has zero counts, a null ``llr`` and fails the rules; repeated rows
    repeat their result; a null key stays. Without trusted rows the ratio decides nothing.
    Only ``key`` and results come back, so other columns cannot clash.
    """
    kind = docs.schema[key].dataType.simpleString()
    good = trusted_keys(labels, key, label)
    rows = texts(docs, key, text)
    # The same join at every size of the label table.
    trusted = rows.join(good.hint("merge"), "key", "left_semi")
    counts = np.stack([gram_counts(rows, buckets), gram_counts(trusted, buckets)])
    ratio = docs.sparkSession.sparkContext.broadcast(log_ratio(counts))

    def mean_ratio(data):
        found = grams(data, buckets=buckets)
        return float(ratio.value[found].mean()) if len(found) else None

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches):
        for batch in row_batches(batches):
            data = byte_texts(batch)
            columns = [pa.array(c, pa.int64()) for c in zip(*map(rules, data), strict=True)]
            llr = pa.array([mean_ratio(d) for d in data], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *columns, llr], ["key", *names, "llr"]
            )

    fields = ", ".join(f"{n} long" for n in names)
    found = rows.mapInArrow(judge, f"key {kind}, {fields}, llr double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > round(100 * MAX_REPEATED) * F.col("n_words")
    )
    found = written(found.withColumn("base_failed", failed), "quality")
    sound = found.filter("not base_failed").select("key", "llr").join(good, "key", "left_semi")
    below = F.coalesce(F.col("llr") < F.lit(lower_bound(sound, trusted_loss)), F.lit(False))
    found = found.withColumn("kept", ~F.col("base_failed") & ~below)
    return found.withColumnRenamed("key", key)


def op8_quality_rules(spark, sf_dir):
    """Rules and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality(docs, labels)
