"""LM scoring: a hidden Markov model over words, trained by Baum-Welch on the corpus."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from foliosift.llm.common import name_of, row_batches, text_batches
from foliosift.session import written

STATES = 6
# Words with a class of their own, and classes that all other words share by their ends.
OWN_WORDS, REST_CLASSES = 1791, 256
END = OWN_WORDS + REST_CLASSES
CLASSES = END + 1
# A word that makes up one in so many words is frequent; so there are no more of them.
FREQUENT = 65_536
# Shares of the training documents, chosen by hash, that the passes cover. The first passes
# part the states; the last ones see every document. All shares grow with the corpus.
SHARES = (1 / 8,) * 6 + (1 / 4, 1.0, 1.0)
PARTS = 64
POOL_TOKENS = 3_000_000
# Bytes of texts that a task splits into words at a time, and of words that it adds up.
TEXT_BYTES, COUNT_BYTES = 1 << 22, 1 << 25
SMOOTH = 0.1


def rest_class(word):
    return OWN_WORDS + zlib.crc32(word[-3:]) % REST_CLASSES


def word_arrays(texts):
    """(place, word) of a column of texts: between ASCII white space, A-Z in lower case."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    places, words = pc.list_parent_indices(split), split.flatten().cast(pa.binary())
    full = pc.greater(pc.binary_length(words), 0)
    return places.filter(full), words.filter(full)


def rest_classes(words):
    """The classes of words without a class of their own, worked out once for each ending."""
    ends = pc.binary_slice(words, -3).dictionary_encode()
    classes = [rest_class(w) for w in ends.dictionary.to_pylist()]
    return np.array(classes, "<u2")[ends.indices.to_numpy()]


class Pool:
    """Class sequences of many documents side by side, longest first.

    Row t holds the tokens at place t of all documents longer than t, so each step of a
    recursion is one array operation over documents and nothing is padded.
    """

    def __init__(self, sequences):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0]) if len(lengths) else 0
        self.live = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.live)])
        flat = np.concatenate([sequences[i] for i in self.order]) if len(lengths) else []
        starts = np.cumsum(lengths) - lengths
        document = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(document)) - starts[document]
        self.tokens = np.empty(len(document), np.int64)
        self.tokens[self.at[place] + document] = flat
        self.count = len(lengths)

    def forward(self, model, keep=False):
        """Log likelihood of each document; with ``keep`` the scaled messages as well."""
        start, move, emit = model
        likelihood, ones = np.zeros(self.count), np.ones(len(start))
        messages = emit.take(self.tokens, axis=0) if keep else None
        scales = np.empty(len(self.tokens)) if keep else None
        before = None
        for t, n in enumerate(self.live):
            span = slice(self.at[t], self.at[t] + n)
            now = messages[span] if keep else emit[self.tokens[span]]
            now *= start if before is None else before[:n] @ move
            scale = now @ ones
            now /= scale[:, None]
            likelihood[:n] += np.log(scale)
            if keep:
                scales[span] = scale
            before = now
        result = np.empty(self.count)
        result[self.order] = likelihood
        return (result, messages, scales) if keep else result

    def counts(self, model):
        """Expected starts, moves and emissions, and the log likelihood."""
        _, move, emit = model
        likelihood, messages, scales = self.forward(model, keep=True)
        moves = np.zeros_like(move)
        after, n_after = None, 0
        for t in range(len(self.live) - 1, -1, -1):
            n = self.live[t]
            span = slice(self.at[t], self.at[t] + n)
            now = emit[self.tokens[span]]
            now /= scales[span][:, None]
            if n_after:
                going = messages[self.at[t] : self.at[t] + n_after]
                moves += going.T @ after
                back = after @ move.T
                now[:n_after] *= back
                going *= back  # now the state probabilities, as where a document ends
            after, n_after = now, n
        starts = messages[: self.live[0]].sum(axis=0) if len(self.live) else np.zeros(len(move))
        emissions = np.stack(
            [np.bincount(self.tokens, messages[:, k], CLASSES) for k in range(len(move))]
        )
        return starts, moves * move, emissions, likelihood.sum()


def model_of(starts, moves, emissions):
    """Probabilities from counts, smoothed so that none is zero; emissions by class."""
    start = (starts + SMOOTH) / (starts + SMOOTH).sum()
    move = (moves + SMOOTH) / (moves + SMOOTH).sum(axis=1, keepdims=True)
    emit = (emissions + SMOOTH) / (emissions + SMOOTH).sum(axis=1, keepdims=True)
    return start, move, np.ascontiguousarray(emit.T)


def start_model(totals, states):
    """Start values: the class counts of the whole corpus, set apart by a fixed random factor."""
    random = np.random.default_rng(7)
    emissions = (totals + SMOOTH) * random.uniform(0.5, 1.5, (states, CLASSES))
    moves = np.ones((states, states)) + 10 * states * np.eye(states)
    return model_of(np.ones(states), moves, emissions)


def word_counts(docs):
    """(word, n_train, n_all, class) of all documents; each task adds up before it sends."""

    def rows_of(train, held):
        counts = [pa.chunked_array(part, pa.binary()).value_counts() for part in (train, held)]
        n_all = np.concatenate([c.field("counts").to_numpy() for c in counts])
        n_train = n_all.copy()
        n_train[len(counts[0]) :] = 0
        words = pa.concat_arrays([c.field("values") for c in counts])
        return pa.RecordBatch.from_arrays(
            [words, pa.array(n_train), pa.array(n_all)], ["word", "n_train", "n_all"]
        )

    def count(batches):
        train, held, size = [], [], 0
        for batch in text_batches(batches, TEXT_BYTES):
            out = batch.column("held_out")
            for part, rows in ((train, pc.invert(out)), (held, out)):
                part.append(word_arrays(batch.column("text").filter(rows))[1])
                size += part[-1].nbytes
            if size >= COUNT_BYTES:
                yield rows_of(train, held)
                train, held, size = [], [], 0
        yield rows_of(train, held)

    rows = docs.mapInArrow(count, "word binary, n_train long, n_all long")
    sums = [F.sum(c).alias(c) for c in ("n_train", "n_all")]
    rest = OWN_WORDS + F.crc32(F.substring("word", -3, 3)) % REST_CLASSES  # as rest_class
    return rows.groupBy("word").agg(*sums).withColumn("class", rest.cast("int"))


def sequences_of(docs, frequent, key_type):
    """Class sequence and sums over frequent words of each document.

    ``frequent`` has these words, their training counts and how many of them, the first
    ones, are classes of their own; it is bounded.
    """

    def read(batches):
        words, counts, n_own = frequent.value
        logs = np.log10(counts + 1.0)
        class_of = np.arange(len(words), dtype="<u2")
        class_of[n_own:] = rest_classes(words[n_own:])
        for batch in text_batches(batches, TEXT_BYTES):
            n = batch.num_rows
            doc, found = word_arrays(batch.column("text"))
            doc, at = doc.to_numpy(), pc.index_in(found, value_set=words)
            rare = at.is_null()
            common = ~rare.to_numpy(zero_copy_only=False)
            classes = np.full(len(doc) + n, END, "<u2")  # each document ends with END
            places = np.arange(len(doc)) + doc
            classes[places[~common]] = rest_classes(found.filter(rare))
            at, doc_at = at.drop_null().to_numpy(), doc[common]
            classes[places[common]] = class_of[at]
            n_tokens = np.bincount(doc, minlength=n) + 1
            ends = np.concatenate([[0], np.cumsum(n_tokens) * classes.itemsize]).astype("<i4")
            known = np.bincount(doc_at, counts[at] > 0, n).astype(np.int64)
            own_logs = np.bincount(doc_at, np.where(at < n_own, logs[at], 0.0), n)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("key", "own", "held_out")),
                    pa.Array.from_buffers(pa.binary(), n, [None, *map(pa.py_buffer, (ends, classes))]),
                    *map(pa.array, (n_tokens, np.bincount(doc_at, logs[at], n), known, own_logs)),
                ],
                ["key", "own", "held_out", "classes", "n_tokens", "logs", "known", "own_logs"],
            )

    schema = (
        f"key {key_type}, own long, held_out boolean, classes binary, n_tokens long, "
        "logs double, known long, own_logs double"
    )
    return docs.mapInArrow(read, schema)


def rare_words(docs, frequent, key_type):
    """(key, own, word, n) for the words of each document that are not frequent."""

    def read(batches):
        words = frequent.value[0]
        for batch in text_batches(batches, TEXT_BYTES):
            doc, found = word_arrays(batch.column("text"))
            rare = pc.invert(pc.is_in(found, value_set=words))
            pairs = pa.table([doc.filter(rare), found.filter(rare)], ["doc", "word"])
            pairs = pairs.group_by(["doc", "word"], use_threads=False)
            pairs = pairs.aggregate([([], "count_all")]).combine_chunks()
            for part in pairs.to_batches():
                at = part.column("doc")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(at),
                        batch.column("own").take(at),
                        part.column("word"),
                        part.column("count_all"),
                    ],
                    ["key", "own", "word", "n"],
                )

    return docs.mapInArrow(read, f"key {key_type}, own long, word binary, n long")


def pools(batches, columns):
    """Documents of a task in pools of about ``POOL_TOKENS`` tokens."""
    held, size = [], 0
    for batch in row_batches(batches):
        held.append(batch.select(columns))
        size += pc.sum(pc.binary_length(batch.column("classes"))).as_py() // 2
        if size >= POOL_TOKENS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def decoded(table):
    return [np.frombuffer(c, "<u2") for c in table.column("classes").to_pylist()]


def expected_counts(sequences, model, states):
    """One Baum-Welch pass: counts of all documents, added up over tasks.

    The result has as many numbers as the model, so it is bounded for any corpus.
    """
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    size = states + states * states + states * CLASSES

    def count(batches):
        total = np.zeros(size)
        for table in pools(batches, ["classes"]):
            starts, moves, emissions, _ = Pool(decoded(table)).counts(shared.value)
            total += np.concatenate([starts, moves.ravel(), emissions.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "x"])

    rows = sequences.select("classes").mapInArrow(count, "i long, x double")
    flat = np.zeros(size)
    for i, x in rows.groupBy("i").agg(F.sum("x").alias("x")).collect():
        flat[i] = x
    a, b = states, states + states * states
    return flat[:a], flat[a:b].reshape(states, states), flat[b:].reshape(states, CLASSES)


def lm_scores(docs, held_out, key="doc_id", text="text", states=STATES, shares=SHARES):
    """Log10 probability of each text under a hidden Markov model of words.

    ``held_out`` is a boolean column; the rows where it is true or null teach nothing.

    A state emits a class and the class a word: the most frequent words are classes of
    their own, other words share classes by their endings, and inside a class a word has
    its smoothed share of all training words, with one place for unknown ones. So the
    model is a distribution over all texts. Baum-Welch starts from the class counts of the
    whole corpus. Each pass adds up expected counts over all tasks and covers a share of the
    training documents, the last passes all of them; no text goes to the driver. The score is
    exact: scaled forward recursion over the whole text and its end.

    Words are counted with addition before the shuffle. Words that are frequent, at most
    ``FREQUENT`` of them by definition, are looked up from a broadcast; the others, spread
    over very many keys, are joined as (document, word, count), without the texts.

    A null or empty text is the end alone. Rows of equal key and text count one by one in
    training and have equal results; a null key stays. A share without documents changes
    nothing. Without training rows every word is unknown. Ties between words of one count go by the word. An empty table gives an empty
    result. Only ``key`` and the results come back.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    base = docs.select(
        name_of(key).alias("key"),
        F.coalesce(name_of(text), F.lit("")).alias("text"),
        F.xxhash64(name_of(text)).alias("own"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
    )
    words = written(word_counts(base.select("text", "held_out")), "words")
    n_docs = base.filter(~F.col("held_out")).count()
    sums = words.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)),
        F.count_if(F.col("n_train") > 0),
        F.coalesce(F.sum("n_all"), F.lit(0)),
    ).first()
    n_train, n_distinct, n_all = sums[0] + n_docs, sums[1] + (n_docs > 0), sums[2]
    often = words.filter(F.col("n_all") * FREQUENT >= n_all).select("word", "n_train").collect()
    ranked = sorted(((-n, bytes(w)) for w, n in often))
    n_own = len([n for n, _ in ranked[:OWN_WORDS] if n < 0])
    frequent = pa.array([w for _, w in ranked], pa.binary())
    frequent = frequent, np.array([-n for n, _ in ranked], np.int64), n_own
    # Words and training count of each shared class, without the words of their own.
    shared = np.zeros((CLASSES, 2))
    for c, n, v in (
        words.groupBy("class").agg(F.sum("n_train"), F.count_if(F.col("n_train") > 0)).collect()
    ):
        shared[c] = n, v
    for n, w in ranked[:n_own]:
        shared[rest_class(w)] += n, -1
    context = spark.sparkContext
    frequent = context.broadcast(frequent)
    sequences = written(sequences_of(base, frequent, key_type), "sequences")

    train = sequences.filter(~F.col("held_out"))
    totals = shared[:, 0].copy()
    totals[:n_own], totals[END] = [-n for n, _ in ranked[:n_own]], n_docs
    model = start_model(totals, states)
    part = F.pmod(F.xxhash64("key", "own"), F.lit(PARTS))
    for share in shares if n_docs else ():
        counts = expected_counts(train.filter(part < round(PARTS * share)), model, states)
        if counts[0].sum() > 0:
            model = model_of(*counts)
    model = context.broadcast(model)
    inside = np.log10(shared.sum(axis=1) + 1)  # shares of a class: N + V + 1
    inside[:OWN_WORDS] = inside[END] = 0

    def score(batches):
        for table in pools(batches, ["key", "own", "classes"]):
            sequences = decoded(table)
            found = Pool(sequences).forward(model.value) / np.log(10)
            found -= np.array([inside[s].sum() for s in sequences])
            columns = [table.column(c).combine_chunks() for c in ("key", "own")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], ["key", "own", "chain"])

    scored = sequences.select("key", "own", "classes").mapInArrow(
        score, f"key {key_type}, own long, chain double"
    )
    # Copies of a document have equal rows: one of them is enough to join.
    scored = scored.groupBy("key", "own").agg(
        F.first("chain").alias("chain"), F.count("*").alias("copies")
    )
    rare = rare_words(base, frequent, key_type)
    joined = rare.join(words.select("word", "n_train").hint("shuffle_hash"), "word", "left")
    c = F.coalesce("n_train", F.lit(0))
    rare = joined.groupBy("key", "own").agg(
        F.sum(F.col("n") * F.log10(c + 1)).alias("rare_logs"),
        F.sum(F.when(c > 0, F.col("n"))).alias("rare_known"),
    )
    same = lambda a, b: a["key"].eqNullSafe(b["key"]) & a["own"].eqNullSafe(b["own"])
    docs_side = sequences.drop("classes")
    found = docs_side.join(scored, same(docs_side, scored), "left").drop(
        scored["key"], scored["own"]
    )
    found = found.join(rare, same(found, rare), "left").drop(rare["key"], rare["own"])
    rare_logs = F.coalesce(F.col("rare_logs") / F.col("copies"), F.lit(0.0))
    rare_known = F.coalesce(F.col("rare_known") / F.col("copies"), F.lit(0.0)).cast("bigint")
    logs = F.col("logs") + rare_logs
    end = float(np.log10(n_docs + 1))
    return found.select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("known") + rare_known + int(n_docs > 0)).cast("bigint").alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (logs + end - F.col("n_tokens") * float(np.log10(n_train + n_distinct + 1))).alias(
            "base_score"
        ),
        (F.col("chain") + logs - F.col("own_logs")).alias("score"),
    )


def op4_lm_scoring(spark, sf_dir):
    """Scores of every document under a model of six documents out of seven."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return lm_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
