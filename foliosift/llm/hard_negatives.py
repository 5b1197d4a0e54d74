"""Hard negatives: rows of another label that score just below a positive of the anchor."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliosift.llm.common import name_of, row_batches
from foliosift.session import scratch_path, written

# Components become floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
# A negative scores from LOW to HIGH hundredths of the positive.
LOW, HIGH = 80, 100
# Anchors that are scored together, and rows that meet them at a time: 8 MB of scores.
ANCHOR_BLOCK, ROW_BLOCK = 2048, 512
# Candidates that a task holds before it keeps the best ones.
HELD = 500_000
# Sums of products below this are exact as floating-point numbers.
EXACT = 2**53


def scaled_rows(rows, anchors, key, label, vector):
    """(id, label, vector, is_anchor) with whole components, without rows that lack anything."""
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    values = rows.select(
        name_of(key).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        name_of(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).filter("id is not null and label is not null and vector is not null")
    whole = F.transform("vector", lambda x: F.floor(x * SCALE).cast("bigint"))
    return values.filter(~broken).select("id", "label", whole.alias("vector"), "is_anchor")


def matrix(column, width):
    """Vectors as the rows of a matrix; what is missing at their ends is 0."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    ends = np.cumsum(lengths)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    for place in range(width):
        at = starts + place
        there = at < ends
        out[there, place] = values[at[there]]
    return out


def scores(rows, anchors):
    """Exact inner products; an error where one could be beyond 64 bits."""
    most = max(map(abs, (int(rows.min(initial=0)), int(rows.max(initial=0)))))
    most *= max(map(abs, (int(anchors.min(initial=0)), int(anchors.max(initial=0)))))
    most *= rows.shape[1]
    if most < EXACT:
        return (rows.astype(np.float64) @ anchors.T.astype(np.float64)).astype(np.int64)
    if most >= 2**63:
        raise ValueError("an inner product does not fit into 64 bits")
    return rows @ anchors.T


class Best:
    """The best ``most`` (score, id) of each slot: high scores first, then small ids.

    Candidates that could still be among the best gather until there are ``HELD`` of them;
    then the best stay, and what is behind them need not be taken any more.
    """

    def __init__(self, slots, most):
        self.most, self.parts, self.size = most, [], 0
        self.score = np.full(slots, np.iinfo(np.int64).min)
        self.id = np.full(slots, np.iinfo(np.int64).max)

    def add(self, slots, found, ids):
        """Candidates: slot, score and id of each."""
        least, last = self.score[slots], self.id[slots]
        good = (found > least) | ((found == least) & (ids < last))
        if good.any():
            self.parts.append((slots[good], found[good], ids[good]))
            self.size += int(good.sum())
            if self.size > HELD:
                self.best()

    def best(self):
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        slots, found, ids = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -found, slots))
        slots, found, ids = slots[order], found[order], ids[order]
        first = np.searchsorted(slots, slots)
        rank = np.arange(len(slots)) - first
        kept = rank < self.most
        last = rank == self.most - 1
        self.score[slots[last]], self.id[slots[last]] = found[last], ids[last]
        self.parts = [(slots[kept], found[kept], ids[kept])]
        self.size = int(kept.sum())
        return self.parts[0]


def anchor_blocks(anchors, size):
    """Lists of at most ``size`` anchors, one after the other."""
    held = []
    for row in anchors.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def scan(rows, anchors, slots_of, count, most, label):
    """(anchor, slot, score, id, rank): the best ``most`` rows of each slot of each anchor.

    Blocks of anchors, of a bounded size, are broadcast one after the other and dropped when
    all rows have met them. Each task keeps the best of its own rows before anything is
    shuffled. ``slots_of(scores, ids, labels, block)`` gives the slot of each pair, or -1.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    schema = "anchor long, slot int, score long, id long"
    spark.createDataFrame([], schema).write.parquet(path)
    for held in anchor_blocks(anchors, ANCHOR_BLOCK):
        vectors = pa.array([a["vector"] for a in held], pa.list_(pa.int64()))
        block = {c: np.array([a[c] for a in held], np.int64) for c in ("anchor", "id", "label")}
        block["vector"] = matrix(vectors, max(len(a["vector"]) for a in held))
        for name in ("upper", "least"):
            if name in held[0]:
                block[name] = np.array([a[name] + [-1] * (count - len(a[name])) for a in held], np.int64)
        shared = spark.sparkContext.broadcast(block)
        found = rows.mapInArrow(best_of(shared, slots_of, count, most), schema)
        found.write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(schema).parquet(path)
    rank = F.row_number().over(W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def best_of(shared, slots_of, count, most):
    """Combiner of a task: its best rows for each anchor and slot."""

    def best(batches):
        block = shared.value
        n, width = block["vector"].shape
        kept = Best(n * count, most)
        base = np.arange(n, dtype=np.int64) * count
        for batch in row_batches(batches, ROW_BLOCK):
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            found = scores(matrix(batch.column("vector"), width), block["vector"])
            slot = slots_of(found, ids, labels, block)
            where = np.nonzero(slot >= 0)
            kept.add(base[where[1]] + slot[where], found[where], ids[where[0]])
        slots, found, ids = kept.best()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block["anchor"][slots // count]),
                pa.array((slots % count).astype(np.int32)),
                pa.array(found),
                pa.array(ids),
            ],
            ["anchor", "slot", "score", "id"],
        )

    return best


def positive_slot(found, ids, labels, block):
    """Slot 0 for the rows of the anchor's label that are not the anchor."""
    other = (labels[:, None] == block["label"]) & (ids[:, None] != block["id"])
    return np.where(other, 0, -1)


def negative_slot(found, ids, labels, block):
    """Slot of a row of another label: that of the smallest upper limit it does not pass.

    Slots do not overlap. A score below the lower limit of its own slot is in no window, as
    all windows that reach the slot from above have lower limits that are no smaller.
    """
    slot = np.full(found.shape, -1, np.int64)
    least = np.zeros_like(found)
    for j, (upper, low) in enumerate(zip(block["upper"].T, block["least"].T, strict=True)):
        inside = (found <= upper) & (upper >= 0)
        slot[inside] = j
        np.copyto(least, low, where=inside)
    return np.where((found >= least) & (labels[:, None] != block["label"]), slot, -1)


def suffix_merges(found, count, most):
    """(anchor, best): for each slot the best ``most`` of it and all slots below it.

    Slots go down in score, so the best of a slot come first and those of the slots below
    fill up what is left.
    """
    tops = [
        F.sort_array(F.collect_list(F.when(F.col("slot") == j, F.struct((-F.col("score")).alias("s"), "id"))))
        for j in range(count)
    ]
    merged = found.groupBy("anchor").agg(*(t.alias(f"slot{j}") for j, t in enumerate(tops)))
    best = []
    for j in range(count - 1, -1, -1):
        below = F.concat(F.col(f"slot{j}"), best[0]) if best else F.col(f"slot{j}")
        best.insert(0, F.slice(below, 1, most))
    return merged.select("anchor", F.array(*best).alias("best"))


def hard_negatives(
    rows, anchors, key="vec_id", label=None, vector="embedding", positives=POSITIVES,
    negatives=NEGATIVES, low=LOW, high=HIGH,
):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a boolean column that tells which rows are anchors, ``label`` a column, by
    default the one of that name. Scores are inner products of vectors whose components are
    floor(256 x). The positives of an anchor are its best ``positives`` other rows of its
    label, the negatives of a positive with score p the best ``negatives`` rows of other
    labels with ``low`` p <= 100 score <= ``high`` p. Higher scores come first, ties by id.

    All rows meet all anchors, in blocks, twice. The first pass keeps the best rows of the
    label. Their scores bound the windows of the negatives from above and split the scores
    of an anchor into disjoint slots. The second pass keeps the best rows of each slot, in
    each task before the shuffle. Merges from the lowest slot up then answer all windows of an anchor,
    however they overlap. No pairs are kept but those that are the best of a task.

    Rows without id, label or vector, or with a null or not finite component, take no part.
    A vector that is shorter than another counts as continued by zeros. A positive below zero
    has no negatives, as its window is empty. Equal anchor rows are one anchor; other repeated
    rows count as often as they occur, and rows with the anchor's id are no positives of it. A
    score beyond 64 bits is an error. Other columns are not used and not returned. Empty
    tables, and tables without anchors, give an empty result.
    """
    if not 0 <= low < high:
        raise ValueError("low has to be less than high, and not negative")
    label = F.col("label") if label is None else label
    rows = written(scaled_rows(rows, anchors, key, label, vector), "vectors")
    own = rows.filter("is_anchor").select("id", "label", "vector").distinct()
    own = written(own.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    rows = rows.drop("is_anchor")
    found = scan(rows, own, positive_slot, 1, positives, "positives")
    slot = F.dense_rank().over(W.partitionBy("anchor").orderBy(F.desc("score"))) - 1
    found = found.filter("score >= 0").select(
        "anchor", F.col("id").alias("positive_id"), "score", slot.cast("int").alias("slot"),
        F.expr(f"cast(score as decimal(20,0)) * {high} div 100").alias("upper"),
        F.expr(f"(cast(score as decimal(20,0)) * {low} + 99) div 100").alias("least"),
    )
    found = written(found, "windows")
    ordered = lambda name: F.sort_array(F.collect_set(F.struct("slot", name)))
    limits = found.groupBy("anchor").agg(
        *(ordered(c).getField(c).alias(c) for c in ("upper", "least"))
    )
    limited = written(own.join(limits, "anchor"), "limits")
    tops = scan(rows, limited, negative_slot, positives, negatives, "negatives")
    best = suffix_merges(tops, positives, negatives)
    window = F.filter(F.col("best")[F.col("slot")], lambda n: -n["s"] >= F.col("least"))
    windows = found.join(best, "anchor").select(
        "anchor", "positive_id", "score", F.posexplode(window).alias("at", "negative")
    )
    names = own.select("anchor", F.col("id").alias("anchor_id"))
    return windows.join(names, "anchor").select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("negative.s")).alias("negative_score"),
    )


def op13_hard_negatives(spark, sf_dir):
    """Hard negatives for one vector in a hundred, against all vectors."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


OP13_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    cast(list_dot_product(a.v, b.v) as bigint) as score
  from vectors a, vectors b where a.vec_id % 100 = 0
), positives as (
  select * from pairs where same and anchor_id <> other_id
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.other_id as positive_id, cast(row_number() over
    (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as integer) as rank,
  n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
  and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify rank <= 5
"""
