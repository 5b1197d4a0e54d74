"""MinHash near-dedup: banded minima, verified links, components by star contraction."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foliosift.llm.common import byte_texts, likely_in, name_of, row_batches, texts
from foliosift.session import written

SHINGLE = 5
# Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
HASHES, MOST_BAND_ROWS = 130, 5
# Share of the pairs at the threshold that may be in no common bucket.
MOST_MISSED = 1e-6
# Signatures that agree in fewer places are dropped before the exact test: so many
# deviations below the share of the threshold, 0.65 for 0.85.
DEVIATIONS = 6.39
MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x):
    x = x ^ (x >> np.uint64(32))
    x = x * STEP
    return x ^ (x >> np.uint64(29))


def bands_of(percent):
    """(bands, rows of a band) that reach pairs of similarity ``percent`` / 100."""
    share = percent / 100
    if share > 1:
        raise ValueError(f"percent is {percent}; no pair is so similar")
    for rows in range(MOST_BAND_ROWS, 0, -1):
        bands = HASHES // rows
        if (1 - share**rows) ** bands <= MOST_MISSED:
            return bands, rows
    raise ValueError(f"{HASHES} hashes do not find pairs of {percent} percent")


def least_agreement(percent):
    """Places in which the signatures of a pair to be tested agree at least."""
    share = percent / 100
    return int(HASHES * (share - DEVIATIONS * (share * (1 - share) / HASHES) ** 0.5))


def shingle_set(data, width=SHINGLE):
    """Sorted distinct 64-bit fingerprints of the word shingles of a text."""
    import xxhash

    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(ids) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mixed(out * MIX + ids[i : i + n])
    return np.unique(out)


def coefficients(hashes):
    """Odd factors and offsets of universal multiply-shift hashes; fixed by the count."""
    random = np.random.default_rng(20)
    a = random.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, random.integers(0, 1 << 63, hashes, np.uint64)


def minima(shingles, a, b):
    """Minimum of each hash over the set; the high half of each is kept."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 256):
        part = shingles[start : start + 256, None] * a
        part += b
        np.minimum(low, part.min(axis=0), out=low)
    return low >> np.uint64(32)


def signatures(rows, shingle=SHINGLE, percent=PERCENT):
    """(node, n, d1, d2, bands, signature) of each text.

    d1 and d2 identify the set; ``bands`` holds one fingerprint a band; ``signature`` has 16
    bits of each minimum.
    """
    a, b = coefficients(HASHES)
    n_bands, band_rows = bands_of(percent)

    def sign(batches):
        for batch in row_batches(batches):
            counts, d1, d2, bands, signature = [], [], [], [], []
            for data in byte_texts(batch):
                found = shingle_set(data, shingle)
                counts.append(len(found))
                d1.append(int(mixed(found * MIX).sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(mixed(found ^ STEP).sum(dtype=np.uint64).view(np.int64)))
                if not len(found):
                    bands.append([])
                    signature.append([])
                    continue
                low = minima(found, a, b)
                hashed = np.zeros(n_bands, np.uint64)
                for column in low[: n_bands * band_rows].reshape(n_bands, band_rows).T:
                    hashed = mixed(hashed * MIX + column)
                bands.append(hashed.view(np.int64))
                signature.append((low & np.uint64(0xFFFF)).astype(np.int16))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(counts, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(signature, pa.list_(pa.int16())),
                ],
                ["node", "n", "d1", "d2", "bands", "signature"],
            )

    node = rows.schema["node"].dataType.simpleString()
    return rows.mapInArrow(
        sign, f"node {node}, n long, d1 long, d2 long, bands array<long>, signature array<short>"
    )


def sizes_allow(one, other, percent):
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def verified(pairs, stored_texts, stored_signatures, percent=PERCENT, shingle=SHINGLE):
    """The pairs (a, b) whose signatures agree and whose full sets are similar enough.

    Each pair meets both signatures, then both texts; all four joins are between stored
    tables, so AQE can split a document that very many others are compared with. Sets whose
    sizes are too far apart are no candidates.
    """
    sign = lambda end: stored_signatures.select(
        F.col("key").alias(end), F.col("n").alias(f"n{end}"), F.col("signature").alias(f"s{end}")
    )
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    near = pairs.join(sign("a"), "a").join(sign("b"), "b").filter(sizes_allow("na", "nb", percent))
    near = near.filter(agree >= least_agreement(percent)).select("a", "b")
    near = written(near, "near")
    text_a = stored_texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    text_b = stored_texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))

    def similar(batches):
        last, kept = None, None
        for batch in row_batches(batches):
            good = []
            columns = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("ta", "tb"))
            for one, other in zip(*columns, strict=True):
                if one != last:
                    last, kept = one, shingle_set(one, shingle)
                found = shingle_set(other, shingle)
                common = len(np.intersect1d(kept, found, assume_unique=True))
                good.append(100 * common >= percent * (len(kept) + len(found) - common))
            mask = pa.array(good, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    both = near.join(text_b, "b").join(text_a, "a").select("a", "b", "ta", "tb")
    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(similar, f"a {kind}, b {kind}")


def state_of(edges):
    """Number of edges and a sum over them: equal for equal sets."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def components(links, stored=written):
    """(key, component) of all ends of the links (a, b); a component is its smallest key.

    Large-star and small-star in turn until nothing changes. Edges are kept as (u, v) with
    u > v. Each step joins edges with the minimum of each node; both are stored tables, so
    the edges of a large star are split over tasks.
    """
    edges = links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(edges.filter("u <> v").distinct(), "edges")
    before = None
    while (now := state_of(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(stored(low, "low"), "u").filter("v > u and v <> m")
        edges = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        low = stored(low, "low")
        small = edges.join(low, "u").filter("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.toDF("u", "v")).distinct(), "edges")
    ends = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct()
    return ends.withColumnRenamed("u", "key").unionByName(roots)


def near_duplicates(docs, key="doc_id", text="text", percent=PERCENT, shingle=SHINGLE):
    """(key, n_shingles, component_id, kept) for each row of ``docs``.

    Documents are linked where 100 * intersection >= ``percent`` * union of their shingle
    sets; a component is all that links reach, named by its smallest key, whose row is kept.

    Documents of equal sets first become one class, so copies cost one row each. Classes in
    a common bucket of a band are candidates, in two steps, so that no step emits the pairs
    of a group. First each class meets one leader: of all classes in its buckets the one that
    shares most buckets with others, which is as a rule the text that the others are copies
    of. Then the classes of buckets that still hold several components meet by their rarest
    shingles, see ``cross_pairs``. Every candidate passes the
    signature and the full sets before it counts. Bands and
    signature test follow ``percent``: a pair at the threshold shares no bucket with a
    probability of 1e-6 at most, 2.4e-7 for 85; values that the hashes do not reach are
    refused. No step caps or samples.

    Texts without words have the empty set and are linked with nothing. Rows of one key are
    one document: each of its texts is compared, and all are linked. A null key is linked
    with nothing: its component is null and the row is kept. An empty table gives an empty result. Only
    ``key`` and the results come back.
    """
    base = texts(docs, key, text)
    node = F.struct("key", F.xxhash64("text").alias("own"))
    base = base.select(node.alias("node"), "text")
    signed = written(signatures(base, shingle, percent), "signed")
    usable = signed.filter("n > 0 and node.key is not null")
    classes = usable.groupBy("d1", "d2", "n").agg(F.min("node").alias("class"))
    classes = written(classes, "classes")
    leaders = usable.join(classes.select(F.col("class").alias("node")), "node", "left_semi")
    leaders = leaders.select(F.col("node").alias("key"), "n", "bands", "signature")
    leaders = written(leaders.dropDuplicates(["key"]), "leaders")
    entries = leaders.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("band", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = with_leaders(entries, written(shared, "buckets"))
    wanted = written(members.select("key").distinct(), "wanted")
    candidates = likely_in(base.withColumnRenamed("node", "key"), wanted, ["key"])
    # Inner joins, as each key is wanted once; a semi join would be moved before the bitmap.
    candidates = candidates.join(wanted, "key")
    stored_texts = written(candidates.dropDuplicates(["key"]), "texts")
    signature = likely_in(leaders.select("key", "n", "signature"), wanted, ["key"])
    signature = written(signature.join(wanted, "key"), "signatures")

    def links_of(pairs):
        pairs = written(pairs.filter("a <> b").distinct(), "pairs")
        return written(verified(pairs, stored_texts, signature, percent, shingle), "links")

    first = members.groupBy("key").agg(F.max(F.struct("weight", "a")).getField("a").alias("a"))
    links = links_of(first.select("a", F.col("key").alias("b")))
    links = links.unionByName(key_links(usable, classes))
    parts = written(components(links), "parts")
    open_ = written(unresolved(members, parts), "open")
    found = links_of(cross_pairs(open_, signature.select("key", "n"), stored_texts, percent, shingle))
    if not found.isEmpty():
        # What is connected so far stays so: each class with its component is enough.
        links = parts.select(F.col("component").alias("a"), F.col("key").alias("b"))
        parts = written(components(links.unionByName(found)), "parts")
    named = usable.select("node", "d1", "d2", "n").join(classes, ["d1", "d2", "n"])
    named = named.join(parts.withColumnRenamed("key", "class"), "class", "left")
    named = named.select("node", F.coalesce("component", "class").getField("key").alias("least"))
    found = signed.select("node", "n").join(named.distinct(), "node", "left")
    name = F.col("node.key")
    component = F.coalesce("least", name)
    return found.select(
        name.alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == name, F.lit(True)).alias("kept"),
    )


def with_leaders(entries, shared):
    """Members (key, band, bucket, a, weight) of the buckets that several classes share.

    The weight of a class adds up the sizes of its buckets; ``a``, the leader of a bucket, is
    its class of the largest weight, and ``weight`` is that of the leader.
    """
    entries = likely_in(entries, shared, ["band", "bucket"])
    members = written(entries.join(shared, ["band", "bucket"]), "members")
    weights = members.groupBy("key").agg(F.sum("size").alias("weight"))
    weighed = written(members.drop("size").join(written(weights, "weights"), "key"), "weighed")
    lead = weighed.groupBy("band", "bucket").agg(F.max(F.struct("weight", "key")).alias("lead"))
    lead = lead.select("band", "bucket", F.col("lead.key").alias("a"), F.col("lead.weight").alias("weight"))
    return written(weighed.drop("weight").join(written(lead, "led"), ["band", "bucket"]), "members")


def key_links(usable, classes):
    """Links between the classes of the different texts of one key."""
    own = usable.select("node.key", "node.own", "node", "d1", "d2", "n")
    several = own.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    several = written(several.filter("a <> z").select("key", "a"), "several")
    texts_of = own.join(several, "key").join(classes, ["d1", "d2", "n"]).select("key", "class")
    texts_of = written(texts_of.distinct(), "keyed")
    ends = texts_of.groupBy("key").agg(F.min("class").alias("a"))
    return texts_of.join(ends, "key").select("a", F.col("class").alias("b"))


def unresolved(members, parts):
    """Members, with their component, of the buckets that hold several components."""
    placed = members.join(parts, "key", "left").select(
        "band", "bucket", "a", "key", F.coalesce("component", "key").alias("component")
    )
    placed = written(placed, "placed")
    mixed_ = placed.groupBy("band", "bucket").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1")
    )
    mixed_ = written(mixed_.filter("c0 <> c1").select("band", "bucket"), "mixed")
    return placed.join(mixed_, ["band", "bucket"], "left_semi")


def cross_pairs(members, sizes, stored_texts, percent, shingle):
    """Pairs of classes of different components that can be similar enough, by rare shingles.

    All shingles have one order, the rarest first. Two sets that overlap enough share one of
    their first ones: up to ``short`` in the smaller set and up to ``long`` in the larger one.
    At the first common shingle what is left of both sets must still be enough. So texts that
    share only what is common to very many do not meet, and classes that are similar enough
    always do. Only the first shingles of a set are joined, each set's own in its own order.
    """
    classes = written(members.select("key", "component").distinct(), "classes")
    texts_ = stored_texts.join(classes.select("key"), "key", "left_semi")

    def sets(batches):
        for batch in row_batches(batches):
            found = [shingle_set(d, shingle).view(np.int64) for d in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.list_(pa.int64()))], ["key", "shingles"]
            )

    kind = stored_texts.schema["key"].dataType.simpleString()
    held = texts_.mapInArrow(sets, f"key {kind}, shingles array<long>")
    held = written(held.select("key", F.explode("shingles").alias("shingle")), "shingles")
    counts = written(held.groupBy("shingle").agg(F.count("*").alias("held")), "counts")
    order = F.sort_array(F.collect_list(F.struct("held", "shingle")))
    ranked = held.join(counts, "shingle").groupBy("key").agg(order.alias("order"))
    ranked = ranked.join(sizes, "key").join(classes, "key")
    long = f"n - ({percent} * n + 99) div 100 + 1"
    short = f"n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1"
    first = ranked.selectExpr(
        "key", "component", "n", f"{short} as short",
        f"posexplode(slice(order, 1, cast({long} as int))) as (at, entry)",
    )
    first = first.filter("entry.held > 1").selectExpr(
        "key", "component", "n", "short", "at + 1 as at", "entry.shingle as shingle"
    )
    first = written(first, "first")
    small = first.filter("at <= short").drop("short").toDF("a", "ca", "na", "ia", "shingle")
    large = first.drop("short").toDF("b", "cb", "nb", "ib", "shingle")
    left = 1 + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    enough = left * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    meet = small["shingle"] == large["shingle"]
    other = F.col("ca") != F.col("cb")
    pairs = small.join(large, meet & other & smaller & enough & sizes_allow("na", "nb", percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def one_of_each(docs, key="doc_id", text="text", percent=PERCENT):
    """``docs`` without the rows that another document of their component stands for.

    Rows without key or words stay.
    """
    found = near_duplicates(docs, key, text, percent)
    gone = found.filter("not kept").select(F.col(key).alias("_gone"))
    gone = written(gone.distinct(), "gone")
    return docs.join(gone, name_of(key) == F.col("_gone"), "left_anti")


def op6_near_dedup(spark, sf_dir):
    """Component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
