"""Mixing: documents of all sources in proportion to target weights, by weighted fair queueing."""

from functools import reduce

from pyspark.sql import functions as F

from foliosift.llm.common import name_of
from foliosift.operators.ordering import numbered, running_total
from foliosift.session import written

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
# How often the mix takes a document at most.
MOST_COPIES = 3
SEED = "mix"


def word_count(text):
    """Words of a text, the measure of its size; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffled(key, seed=SEED):
    """Sort key that brings documents into a random order, the same one in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def with_targets(sources, total, most=MOST_COPIES):
    """Add ``target`` to (size, weight, ...): shares of ``total`` by weight.

    A target stops at ``most`` times the size of its source, and what it leaves is shared
    again by weight. Each round asks for two sums and a count over the sources; the sources
    that are full stay so, and rounds end when none is added.
    """
    limit = (F.col("size") * most).cast("decimal(38,0)")
    before, full = -1, F.lit(False)
    while True:
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count_if(full),
        ).first()
        spare, weights = total - int(row[0]), int(row[1])
        if row[2] == before or not weights:
            break
        before = row[2]
        full = limit * F.lit(weights) < F.col("weight").cast("decimal(38,0)") * F.lit(spare)
    share = (F.col("weight") * F.lit(spare)).cast("double") / F.lit(float(max(weights, 1)))
    return sources.withColumn("target", F.when(full, limit.cast("double")).otherwise(share))


def mixture(
    docs, key="doc_id", group="source", text="text", size=None, weights=WEIGHTS, most=MOST_COPIES, seed=SEED
):
    """(key, group, own, size, source_size, target, copies, taken, finishes) for each document.

    Sources have the ``weights`` in the order of their names, null last, and share the size of
    all documents by them, as ``with_targets`` says. Each source queues its documents in
    shuffled order, up to ``most`` times over. A copy finishes at the tokens of its source so
    far, its own included, divided by the target of the source: a virtual time, in which all
    sources end at 1. All copies are sorted by it, range by range, and the mix is cut where
    their running size passes the size of all documents. A source misses its target by about
    one document. ``finishes`` are the virtual times of the copies that the mix takes, and
    ``taken`` their size together.

    Only sizes and names are sorted, never texts. The sums inside a source come from one prefix
    sum over all of them, so a source that has a third of all rows is dealt out like the rest.
    The cut is a single row, and a document knows from it which of its copies are taken.

    ``size`` is a column of whole numbers from 0 on, the words of ``text`` by default. A null or
    empty text has size 0 and nothing taken. Rows are queued one by one, also repeated ones and
    those without key; equal rows are interchangeable, so reruns agree. ``own`` tells texts of
    one key apart. Only the named columns come back, so others cannot clash. An empty table gives an empty
    result, and a table of empty texts takes nothing.
    """
    size = word_count(name_of(text)) if size is None else F.coalesce(size, F.lit(0)).cast("bigint")
    queue = docs.select(
        name_of(key).alias("key"),
        name_of(group).alias("group"),
        F.xxhash64(name_of(text)).alias("own"),
        size.alias("size"),
        shuffled(name_of(key), seed).alias("turn"),
    )
    order = [F.asc_nulls_last("group"), F.asc("turn"), F.asc("key"), F.asc("size"), F.asc("own")]
    queue = written(running_total(queue, order, "size", "upto"), "queue")
    sources = queue.groupBy("group").agg(
        F.sum("size").alias("size"), F.min(F.col("upto") - F.col("size")).alias("first")
    )
    sources = numbered(sources, [F.asc_nulls_last("group")], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(sources.withColumn("weight", weight.cast("bigint")), "sources")
    total = sources.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sources = with_targets(sources, total, most).select(
        F.col("group").alias("_group"), F.col("size").alias("source_size"), "first", "rank", "target"
    )
    placed = queue.join(written(sources, "targets"), F.col("group").eqNullSafe(F.col("_group")))
    # What the source has handed out after each copy of a document, and when that is.
    passed = [F.col("source_size") * e + F.col("upto") - F.col("first") for e in range(most)]
    copies = F.array(
        *(
            F.when(
                F.col("source_size") * e < F.col("target"),
                F.struct(
                    (p.cast("double") / F.col("target")).alias("finish"), "rank", p.alias("passed")
                ),
            )
            for e, p in enumerate(passed)
        )
    )
    placed = placed.withColumn("queued", F.array_compact(copies))
    sized = placed.filter("size > 0").select(F.inline("queued"), "size")
    ends = running_total(sized, [F.asc(c) for c in ("finish", "rank", "passed")], "size", "upto")
    last = ends.filter(F.col("upto") <= total).agg(F.max(F.struct("finish", "rank", "passed"))).first()[0]
    within = lambda c: _up_to(c, last) if last else F.lit(False)
    finishes = F.transform(F.filter("queued", within), lambda c: c["finish"])
    return placed.select(
        F.col("key").alias(key), F.col("group").alias(group), "own", "size", "source_size", "target",
        F.size(finishes).cast("bigint").alias("copies"),
        (F.size(finishes) * F.col("size")).cast("bigint").alias("taken"),
        finishes.alias("finishes"),
    )


def _up_to(copy, last):
    """Whether a copy comes no later than ``last``: (finish, rank, passed)."""
    names = ("finish", "rank", "passed")
    tests = []
    for i, name in enumerate(names):
        same = [copy[n] == F.lit(last[n]) for n in names[:i]]
        here = copy[name] <= F.lit(last[name]) if i == len(names) - 1 else copy[name] < F.lit(last[name])
        tests.append(reduce(lambda a, b: a & b, [*same, here]))
    return reduce(lambda a, b: a | b, tests)


def mixed_documents(docs, mix, key="doc_id", group="source", text="text"):
    """The documents of a ``mixture``, once for each copy, with ``finish``; sort by it to feed.

    Rows with equal key, source and text stand for each other: one of them is repeated for
    the copies of them all. Other columns stay; ``finish`` is replaced.
    """
    times = mix.groupBy(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{group}`").alias("_group"), F.col("own").alias("_own")
    ).agg(F.flatten(F.collect_list("finishes")).alias("_times"))
    times = written(times.filter(F.size("_times") > 0), "times")
    own = docs.drop("finish").withColumn("_same", F.xxhash64(name_of(text)))
    own = own.dropDuplicates([key, group, "_same"])
    same = (
        name_of(key).eqNullSafe(F.col("_key"))
        & name_of(group).eqNullSafe(F.col("_group"))
        & (F.col("_same") == F.col("_own"))
    )
    found = own.join(times, same).drop("_key", "_group", "_own", "_same")
    return found.select("*", F.explode("_times").alias("finish")).drop("_times")


def op12_source_mix(spark, sf_dir):
    """What a mix of all documents by weighted sources takes of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


OP12_SQL = f"""
with queue as (
  select doc_id, source, size, turn, sum(size) over
      (partition by source order by turn, doc_id, size rows unbounded preceding) as upto
  from (select doc_id, source, md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as turn,
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size from documents)
), sources as (
  select source, sum(size) as size, row_number() over (order by source nulls last) - 1 as rank from queue group by source
), weighted as (
  select *, rank % 3 + 1 as weight, {MOST_COPIES} * size as cap, sum(size) over () as total from sources
), filled as (
  select *, coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0) as used,
    sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as rest
  from weighted
), level as (
  select total - used as num, rest as den from filled where cap * rest >= weight * (total - used)
  order by cap / weight, rank limit 1
), targets as (
  select source, size, rank, total, case when cap * den < weight * num then cast(cap as double)
    else cast(weight * num as double) / cast(den as double) end as target
  from weighted, level
), copies as (
  select q.*, t.rank, total, target, t.size as source_size, e * t.size + upto as passed,
    cast(e * t.size + upto as double) / target as finish
  from queue q join targets t on q.source is not distinct from t.source, range({MOST_COPIES}) r(e)
  where e * t.size < target and q.size > 0
), sorted as (
  select *, sum(size) over (order by finish, rank, passed rows unbounded preceding) as ended from copies
), taken as (
  select rank, doc_id, turn, upto, sum(size) as taken from sorted where ended <= total group by all
)
select q.doc_id, q.size, cast(t.size as bigint) as source_size, target, cast(coalesce(k.taken, 0) as bigint) as taken
from queue q join targets t on q.source is not distinct from t.source
left join taken k on k.rank = t.rank and k.turn = q.turn and k.upto = q.upto and q.size > 0
"""
