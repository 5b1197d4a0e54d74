"""Merkle manifest: digests of a table, in levels kept as one hex string for each block."""

from pyspark.sql import functions as F

from foliosift.llm.common import lowered, name_of
from foliosift.operators.ordering import numbered
from foliosift.session import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, DIGEST = 16, 64
# Levels that one block holds; so it covers FANOUT ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 2
SPAN = FANOUT**BLOCK_LEVELS
PATH = "array<struct<before:string,after:string>>"


def leaf_digest(columns):
    """Digest of columns: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    values = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def parents(level):
    """The level above a level: the digest of each run of ``FANOUT`` digests."""
    width = FANOUT * DIGEST
    runs = f"sequence(0, (length({level}) - 1) div {width})"
    digest = f"sha2(substring({level}, cast(i * {width} + 1 as int), {width}), 256)"
    return F.expr(f"array_join(transform({runs}, i -> {digest}), '')")


def blocks_of(nodes, extra):
    """Nodes (group, size, index, digest, ...) in aligned blocks, stored.

    A block has its members, its levels as strings from ``level0`` on, null above the root
    of a group that is not so high, and the digest on top.
    """
    block = F.expr(f"index div {SPAN}").alias("block")
    members = F.sort_array(F.collect_list(F.struct("index", "digest", *extra)))
    blocks = nodes.groupBy("group", "size", block).agg(members.alias("members"))
    blocks = blocks.withColumn("level0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    for k in range(BLOCK_LEVELS):
        above = F.when(F.col("size") > FANOUT**k, parents(f"level{k}"))
        blocks = blocks.withColumn(f"level{k + 1}", above)
    levels = [f"level{k}" for k in range(BLOCK_LEVELS, -1, -1)]
    return written(blocks.withColumn("top", F.coalesce(*levels)), "blocks")


def climbed(nodes, extra=()):
    """Rounds of blocks up to one block for each group; each round's tops are the next nodes."""
    rounds = [blocks_of(nodes, extra)]
    while not rounds[-1].filter(F.col("size") > SPAN).isEmpty():
        tops = rounds[-1].select(
            "group",
            F.expr(f"(size + {SPAN - 1}) div {SPAN}").alias("size"),
            F.col("block").alias("index"),
            F.col("top").alias("digest"),
        )
        rounds.append(blocks_of(tops, ()))
    return rounds


def flanks(k):
    """Siblings before and after the member at ``place`` on level ``k``, cut from its string."""
    at = f"(place div {FANOUT**k})"
    start = f"({at} - {at} % {FANOUT})"
    cut = lambda first, count: F.expr(
        f"substring(level{k}, cast({first} * {DIGEST} + 1 as int), cast({count} * {DIGEST} as int))"
    )
    before, after = cut(start, f"({at} - {start})"), cut(f"({at} + 1)", f"({start} + {FANOUT - 1} - {at})")
    return F.when(F.col("size") > FANOUT**k, F.struct(before.alias("before"), after.alias("after")))


def descended(rounds, roots, carried, extra=()):
    """Each node of the first round with the siblings on its way up.

    ``roots`` has, for each group, the path above its root and the columns ``carried``. Every
    round but the first has one row for each block below it, and a block meets its row by an
    equality join; the members of a block come from it in place, without a shuffle.
    """
    above = roots
    for k in range(len(rounds) - 1, -1, -1):
        above = above.toDF(*(f"_{c}" for c in above.columns))
        met = rounds[k].join(
            above, F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_index"))
        )
        names = ["index", "digest", *(extra if k == 0 else ())]
        rows = met.select(
            "group", "size", *(f"level{n}" for n in range(BLOCK_LEVELS)), "_path",
            *(f"_{c}" for c in carried), F.posexplode("members").alias("place", "member"),
        )
        own = F.array_compact(F.array(*(flanks(n) for n in range(BLOCK_LEVELS))))
        above = rows.select(
            "group",
            *(F.col(f"member.{n}").alias(n) for n in names),
            F.concat(own, "_path").alias("path"),
            *(F.col(f"_{c}").alias(c) for c in carried),
        )
        if k:
            above = written(above, "paths")
    return above


def merkle_manifest(docs, key="doc_id", group="source", fields=FIELDS, carried=()):
    """(group, key, index, leaf, subroot, root, path, carried columns) for each row of ``docs``.

    A leaf is the digest of the row's ``fields``. The leaves of a group, by key, form a tree
    in which every 16 consecutive nodes of a level give one above, down to a single node, the
    subroot; a lone leaf is its own subroot. The subroots by group, null first, form a tree in
    the same way, whose top is the root. ``path`` lists the siblings of each level, before and
    after, from the leaf to the root.

    Leaves are numbered in Spark, with range partitions of groups and keys, so a group that
    has a third of all rows is dealt out. 256 consecutive leaves are one block: it keeps each
    level as one string of digests, from which fixed-width substrings give parents and
    siblings. The tops of the blocks are the nodes of the next round, 256 times fewer. Then
    each round hands its paths down to the blocks below. Texts are never shuffled.

    A null field is ``-``; a null key comes first in its group, and null is a group. Rows of
    one key are ordered by their leaf, so equal rows are interchangeable and count one by one.
    Only the columns named above come back, so others cannot clash; ``carried`` ones are kept
    beside the leaf and should be small. An empty table gives an empty result.
    """
    own = [f"c{i}" for i in range(len(carried))]
    leaves = docs.select(
        name_of(group).alias("group"),
        name_of(key).alias("key"),
        leaf_digest([name_of(f) for f in fields]).alias("digest"),
        *(name_of(c).alias(o) for c, o in zip(carried, own, strict=True)),
    )
    placed = numbered(leaves, [F.asc("group"), F.asc("key"), F.asc("digest")], "at")
    groups = placed.groupBy("group").agg(F.min("at").alias("_first"), F.count("*").alias("size"))
    groups = written(groups.withColumnRenamed("group", "_group"), "groups")
    nodes = placed.join(groups, F.col("group").eqNullSafe(F.col("_group")))
    nodes = nodes.withColumn("index", F.col("at") - F.col("_first"))
    rounds = climbed(nodes, ["key", *own])

    tops = rounds[-1].select("group", F.col("top").alias("digest"))
    sources = numbered(tops.withColumnRenamed("group", "item"), [F.asc("item")], "index")
    sources = sources.select("*", F.lit(0).alias("group"), F.lit(tops.count()).cast("bigint").alias("size"))
    upper = climbed(sources, ["item"])
    zero, empty = F.lit(0).cast("bigint").alias("index"), F.array().cast(PATH).alias("path")
    root = upper[-1].select("group", zero, empty, F.col("top").alias("root"))
    subroots = descended(upper, root, ["root"], ["item"])
    subroots = subroots.select(
        F.col("item").alias("group"), zero, "path", "root", F.col("digest").alias("subroot")
    )
    found = descended(rounds, written(subroots, "subroots"), ["subroot", "root"], ["key", *own])
    return found.select(
        F.col("group").alias(group), F.col("key").alias(key), "index", F.col("digest").alias("leaf"),
        "subroot", "root", "path", *(F.col(o).alias(c) for c, o in zip(carried, own, strict=True)),
    )


def folded(leaf, path):
    """Root that follows from a leaf and the siblings on its way."""
    step = lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256)
    return F.aggregate(path, leaf, step)


def proof_text(path):
    """All siblings of a path, level by level and from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def op11_merkle_manifest(spark, sf_dir):
    """Manifest of every document; the leaves of some are recomputed after tampering."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = {f: F.col(f) for f in FIELDS} | {"text": lowered(F.col("text"))}
    observed = F.when(tampered, leaf_digest([found[f] for f in FIELDS]))
    rows = merkle_manifest(docs.withColumn("observed", observed), carried=["observed"])
    rows = rows.withColumn("folded_root", folded(F.coalesce("observed", "leaf"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _tree_sql(name, group, levels):
    """Levels of a tree as tables: (group, i, d, n) and its runs, from ``name``0 on."""
    for k in range(levels):
        yield f"""{name}_run{k} as (
          select {group} as g, i // {FANOUT} as run, list(d order by i) as ds, any_value(n) as n
          from {name}{k} group by {group}, i // {FANOUT}
        ), {name}{k + 1} as (
          select g as {group}, run as i, case when n > 1 then sha256(array_to_string(ds, '')) else ds[1] end as d,
            (n + {FANOUT - 1}) // {FANOUT} as n from {name}_run{k}
        )"""


def _fold_sql(name, levels, before, group, at):
    """Rows of ``before`` with their siblings and folded digest after each level of a tree."""
    for k in range(levels):
        last = f"{name}_fold{k - 1}" if k else before
        off = f"(b.{at} // {FANOUT**k} % {FANOUT})"
        first, second = f"array_to_string(ds[1:{off}], '')", f"array_to_string(ds[{off} + 2:], '')"
        yield f"""{name}_fold{k} as (
          select b.* exclude (proof, f), case when r.n > 1 then proof || {first} || {second} else proof end as proof,
            case when r.n > 1 then sha256({first} || f || {second}) else f end as f
          from {last} b join {name}_run{k} r on r.g is not distinct from b.{group} and r.run = b.{at} // {FANOUT ** (k + 1)}
        )"""


def _leaf_sql(text):
    values = [f"cast({f} as varchar)" if f != "text" else text for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# Levels beyond the height of a tree change nothing, so these hold up to 16^6 rows a source.
_LEVELS = 6
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(cast(doc_id as varchar), ''), lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295)"""
OP11_SQL = (
    f"""
with leaves as (
  select doc_id, source, {_leaf_sql("text")} as d, coalesce({_CRC} % 5 = 0, false) as tampered,
    {_leaf_sql(f"translate(text, {_UPPER})")} as altered
  from documents
), d0 as (
  select *, row_number() over (partition by source order by doc_id nulls first, d) - 1 as i,
    count(*) over (partition by source) as n from leaves
), """
    + ", ".join(_tree_sql("d", "source", _LEVELS))
    + f""", s0 as (
  select 0 as tree, source, d, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n
  from d{_LEVELS}
), """
    + ", ".join(_tree_sql("s", "tree", _LEVELS))
    + ", start as (select d0.*, '' as proof, case when tampered then altered else d end as f from d0), "
    + ", ".join(_fold_sql("d", _LEVELS, "start", "source", "i"))
    + f""", sourced as (
  select b.*, s0.i as si, s0.d as subroot, 0 as tree from d_fold{_LEVELS - 1} b
  join s0 on s0.source is not distinct from b.source
), """
    + ", ".join(_fold_sql("s", _LEVELS, "sourced", "tree", "si"))
    + f"""
select b.doc_id, b.d as leaf, subroot, t.d as root, sha256(proof) as proof_sha256, f as folded_root, f = t.d as verified
from s_fold{_LEVELS - 1} b, s{_LEVELS} t
"""
)
