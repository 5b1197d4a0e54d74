"""Toxicity: a chain of linear classifiers over words and their beginnings."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from foliosift.llm.common import name_of, row_batches, row_of, with_columns
from foliosift.llm.decontamination import words_of
from foliosift.session import written

# Categories in the order of the chain; the last one decides.
CATEGORIES = ("quality", "toxic")
# Labelled rows that the models are fitted on at most, chosen by hash.
LABELLED_ROWS = 12_000
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
FOLDS = 3
REGULARISATION, ITERATIONS, TOLERANCE = 1e-3, 60, 1e-6
# Rows that a feature needs, and rows that the share of a label counts for beside them.
LEAST_ROWS, PRIOR = 3, 10.0
# Log odds of a category whose labels are all alike.
SURE = 12.0
THRESHOLD = 0.5
# Rows that are multiplied at a time.
ROW_BLOCK = 1000
CACHE_WORDS = 150_000


def word_features(word, buckets=BUCKETS):
    """Buckets of a word and of its first characters."""
    text = word.decode()
    parts = [b"w" + word] + [b"%d" % n + text[:n].encode() for n in PREFIXES if len(text) >= n]
    return tuple(zlib.crc32(p) % buckets for p in parts)


class Features:
    """Distinct buckets of a text; features of recent words are remembered."""

    def __init__(self, buckets=BUCKETS):
        self.buckets, self.cache = buckets, {}

    def of(self, data):
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        found, cache = set(), self.cache
        for word in set(words_of(data)):
            features = cache.get(word)
            if features is None:
                features = cache[word] = word_features(word, self.buckets)
            found.update(features)
        return np.sort(np.fromiter(found, np.int64, len(found)))


def labelled_rows(docs, labels, key, text, categories, most):
    """(key, fold, labels, features, earlier) of at most ``most`` labelled documents."""
    names = [F.col(f"`{c}`").cast("double").alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.select(name_of(key).alias("key"), *names).dropna()
    labels_ = [f"y{i}" for i in range(len(categories))]
    known = known.groupBy("key").agg(F.min(F.struct(*labels_)).alias("y")).select("key", "y.*")
    known = known.orderBy(F.xxhash64("key"), "key").limit(most)
    # At most ``most`` rows of a key and a few numbers, whatever the label table holds.
    rows = docs.select(name_of(key).alias("key"), name_of(text).alias("text"))
    rows = rows.join(F.broadcast(known), "key").groupBy("key", *labels_).agg(F.min("text").alias("text"))

    def read(batches):
        features = Features()
        for batch in row_batches(batches):
            data = batch.column("text").cast(pa.binary()).to_pylist()
            found = pa.array([features.of(d or b"").astype(np.int32) for d in data], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(batch.column(c) for c in labels_), found],
                ["key", *labels_, "features"],
            )

    kind = docs.schema[key].dataType.simpleString()
    fields = ", ".join(f"{c} double" for c in labels_)
    rows = rows.mapInArrow(read, f"key {kind}, {fields}, features array<int>")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(FOLDS)).cast("int")
    return rows.select("*", fold.alias("fold"), F.array().cast("array<double>").alias("earlier"))


def dense(n, earlier):
    """Two measures of length, as long texts gather weight by chance, and earlier results."""
    return np.column_stack([np.log1p(n) / 3, np.sqrt(n) / 30, earlier])


class Rows:
    """Sparse rows with a few dense columns, multiplied in blocks of a bounded size."""

    def __init__(self, features, earlier):
        self.lengths = np.array([len(f) for f in features], np.int64)
        self.blocks = [
            (i, np.concatenate(features[i : i + ROW_BLOCK]), self.lengths[i : i + ROW_BLOCK])
            for i in range(0, len(features), ROW_BLOCK)
        ]
        self.dense = dense(self.lengths, earlier)
        self.size = BUCKETS + self.dense.shape[1]

    def times(self, weights):
        """Rows times weights, the last of which is the intercept."""
        out = self.dense @ weights[BUCKETS:-1] + weights[-1]
        for start, places, lengths in self.blocks:
            row = np.repeat(np.arange(len(lengths)), lengths)
            out[start : start + len(lengths)] += np.bincount(row, weights[places], len(lengths))
        return out

    def summed(self, values):
        """Weighted sum of the rows, and of the ones that belong to the intercept."""
        out = np.zeros(self.size + 1)
        out[BUCKETS:-1] = values @ self.dense
        out[-1] = values.sum()
        for start, places, lengths in self.blocks:
            each = np.repeat(values[start : start + len(lengths)], lengths)
            out[:BUCKETS] += np.bincount(places, each, BUCKETS)
        return out


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fitted(rows, y):
    """Weights and intercept of a logistic regression; constant labels give no weights."""
    if len(y) == 0 or y.min() == y.max():
        out = np.zeros(rows.size + 1)
        out[-1] = SURE if len(y) and y[0] == 1 else -SURE
        return out

    scale = evidence(rows, y)
    # Both labels weigh the same, however rare one of them is.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(w):
        z = rows.times(w * scale)
        value = weight @ (np.logaddexp(0, z) - y * z) + REGULARISATION / 2 * (w[:-1] @ w[:-1])
        slope = rows.summed(weight * (logistic(z) - y)) * scale
        slope[:-1] += REGULARISATION * w[:-1]
        return value, slope

    return minimised(loss, np.zeros(rows.size + 1)) * scale


def evidence(rows, y):
    """Factor of each column: the log odds of the label with the feature, against those without.

    So features that go with one label all the time are cheap for the regularisation, and those
    of a row or two, which could only learn these by heart, are left out.
    """
    share = y.mean()
    with_label, n = rows.summed(y)[:BUCKETS], rows.summed(np.ones(len(y)))[:BUCKETS]
    odds = (with_label + PRIOR * share) / (n - with_label + PRIOR * (1 - share))
    out = np.ones(rows.size + 1)
    out[:BUCKETS] = np.where(n >= LEAST_ROWS, np.log(odds * (1 - share) / share), 0)
    return out


def minimised(loss, w, iterations=ITERATIONS, memory=8):
    """Minimum of a convex function by L-BFGS with halved steps."""
    value, slope = loss(w)
    pairs = []
    for _ in range(iterations):
        step, shares = slope.copy(), []
        for s, y in reversed(pairs):
            shares.append((s @ step) / (y @ s))
            step -= shares[-1] * y
        if pairs:
            s, y = pairs[-1]
            step *= (s @ y) / (y @ y)
        for s, y in pairs:
            step += s * (shares.pop() - (y @ step) / (y @ s))
        fall, length = slope @ step, 1.0
        while True:
            there = w - length * step
            now, turned = loss(there)
            if now <= value - 1e-4 * length * fall or length < 1e-6:
                break
            length /= 2
        s, y = there - w, turned - slope
        settled = value - now < TOLERANCE
        w, value, slope = there, now, turned
        if settled:
            break
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
    return w


def probability(weights, features, earlier):
    """Probability of one row."""
    tail = dense(np.array([len(features)]), np.array([earlier]))[0]
    z = weights[features].sum() + weights[BUCKETS:-1] @ tail + weights[-1]
    return float(logistic(z))


def fit_model(label, key_type):
    """Fits the model of a group: all rows, or those outside a fold, whose rows it then judges."""

    def fit(table):
        model = table.column("model")[0].as_py()
        fold = table.column("fold").to_numpy()
        lists = pa.concat_arrays(table.column("features").chunks)
        flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy()).tolist()
        features = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        earlier = np.array(table.column("earlier").to_pylist(), np.float64).reshape(len(fold), -1)
        y = table.column(label).to_numpy()
        order = np.argsort([str(k) for k in table.column("key").to_pylist()], kind="stable")
        seen = [i for i in order if fold[i] != model]
        weights = fitted(Rows([features[i] for i in seen], earlier[seen]), y[seen])
        if model == FOLDS:
            columns = [pa.nulls(1, key_type), pa.nulls(1, pa.float64()), pa.array([weights.tobytes()])]
        else:
            held = np.flatnonzero(fold == model)
            p = [probability(weights, features[i], earlier[i]) for i in held]
            columns = [
                table.column("key").combine_chunks().take(pa.array(held)),
                pa.array(p, pa.float64()),
                pa.nulls(len(held), pa.binary()),
            ]
        return pa.table(columns, names=["key", "p", "weights"])

    return fit


def fitted_chain(docs, labels, key="doc_id", text="text", categories=CATEGORIES, most=LABELLED_ROWS):
    """The weights of each category's model, in the order of the chain; the last is the intercept.

    A later model sees the probabilities of the earlier categories. For training these are
    out of fold: each row gets them from a model that has not seen it. The models of a
    category, one for each fold and one for all rows, are fitted side by side, each in a task
    that holds the labelled rows, at most ``most``. The driver gets one row of weights.
    """
    rows = written(labelled_rows(docs, labels, key, text, categories, most), "labelled")
    kind = docs.schema[key].dataType.simpleString()
    key_type = to_arrow_type(docs.schema[key].dataType)
    chain = []
    for i in range(len(categories)):
        last = i + 1 == len(categories)
        models = F.array(*(F.lit(m) for m in ([] if last else range(FOLDS))), F.lit(FOLDS))
        groups = rows.withColumn("model", F.explode(models)).groupBy("model")
        schema = f"key {kind}, p double, weights binary"
        found = written(groups.applyInArrow(fit_model(f"y{i}", key_type), schema), "models")
        own = found.filter("weights is not null").first()
        if own is None:  # no labelled rows
            return [fitted(Rows([], np.zeros((0, n))), np.zeros(0)) for n in range(len(categories))]
        chain.append(np.frombuffer(own["weights"]))
        if not last:
            judged = found.filter("weights is null").select("key", "p")
            rows = rows.join(judged, rows["key"].eqNullSafe(judged["key"])).select(
                *(rows[c] for c in rows.columns if c != "earlier"),
                F.array_append("earlier", F.col("p")).alias("earlier"),
            )
            rows = written(rows, "chained")
    return chain


def toxicity(
    docs, labels, key="doc_id", text="text", categories=CATEGORIES, threshold=THRESHOLD,
    labelled_rows=LABELLED_ROWS,
):
    """``docs`` with the probability ``p_<category>`` of each category and ``rejected``.

    A classifier chain: each category has a logistic regression over the distinct words of
    a text and their first characters, in ``BUCKETS`` hashed features, and the probabilities
    of the categories before it. The last category decides: ``rejected`` where it reaches
    ``threshold``. ``categories`` names columns of ``labels``; the given labels know one kind
    of toxicity and the quality of a text, so the quality comes first in the chain. The models
    are fitted on at most ``labelled_rows`` labelled documents, chosen by hash; every document
    is scored, in one pass without shuffle. The models that are broadcast have a fixed size.

    A null or empty text has no features and gets the models' base rate. Rows are scored one
    by one, repeated ones too. Labels with a null are left out; of several labels of a key
    the least one counts, and of its documents the one with the least text. Without labels, or with one kind only, a category is a constant (unlikely
    without labels). An empty table gives an empty result. Other columns stay, also where
    they clash with working columns; the columns named above are replaced.
    """
    chain = fitted_chain(docs, labels, key, text, categories, labelled_rows)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    rows = docs.select(row_of(docs))

    def score(batches):
        features = Features()
        for batch in row_batches(batches):
            row, out = batch.column("row"), []
            for data in row.field(text).cast(pa.binary()).to_pylist():
                found, earlier = features.of(data or b""), []
                for weights in shared.value:
                    earlier.append(probability(weights, found, earlier))
                out.append(earlier)
            found = pa.array(out, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([row, found], ["row", "p"])

    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"row {kind}, p array<double>")
    new = {f"p_{c}": F.col("p")[i] for i, c in enumerate(categories)}
    new["rejected"] = F.col("p")[len(categories) - 1] >= threshold
    return with_columns(scored, new, docs.columns)


def op9_toxicity(spark, sf_dir):
    """Probabilities and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs, labels).drop("text")
