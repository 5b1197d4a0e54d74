"""Packing: token pieces into sequences under several limits at once."""

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from foliosift.llm.common import name_of, text_batches, texts

TOKENIZER = "word_bpe_49k.json"
LAST_ID = 1
LENGTH = 2048
# Pieces in a sequence, and tokens in it that carry loss.
MAX_SEGMENTS, MAX_LOSS = 128, 2048
# A gap shorter than this stays open, as a cut for it would make too short a piece.
MIN_PIECE = 8
# Tokens that are held and placed together.
BLOCK_TOKENS = 2_000_000
# Bytes of text that are split into words together.
BLOCK_BYTES = 8 << 20
# Words whose ids a Python worker remembers.
CACHE_WORDS = 1_200_000
# ASCII marks that the tokenizer splits from letters in front of them; the apostrophe is none.
MARKS = "".join(map(chr, [*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
COLUMNS = (
    "key {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, loss_tokens long"
)


class WordIds:
    """Token ids of whole texts, word by word.

    The tokenizer drops white space and never joins what it separates, so a text's ids are
    those of its words. Words come back from a bounded cache; all new words of a block go
    to the tokenizer as one text, and its offsets tell which ids belong to which word.
    """

    def __init__(self, path, cache_words=CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache, self.cache_words = {}, cache_words

    def learn(self, words):
        """Ids of new words; of letters with marks behind them as those of both."""
        ids, asked, split = self.cache, set(), []
        for word in words:
            letters = word.rstrip(MARKS)
            if letters.isascii() and letters.isalpha():
                low, marks = letters.lower(), word[len(letters) :]
                split.append((word, low, marks))
                asked.add(low)
                asked.add(marks)
            else:
                asked.add(word)
        self.ask([word for word in asked if word not in ids])
        for word, low, marks in split:
            ids[word] = ids[low] + ids[marks]

    def ask(self, words):
        code = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids, owner = np.array(code.ids, "<u4").tobytes(), np.array(code.word_ids, np.int64)
        ends = 4 * np.searchsorted(owner, np.arange(len(words)), side="right")
        at = 0
        for word, end in zip(words, ends.tolist(), strict=True):
            self.cache[word] = ids[at:end]
            at = end

    def encode_all(self, column):
        """Ids of each text as little-endian 32-bit numbers.

        Words become numbers of the distinct words of the block, in Arrow, so that Python
        looks up each distinct word once and numpy puts the ids of all texts together.
        """
        words = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        distinct, each = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        found = list(map(self.cache.get, distinct))
        if new := [word for word, ids in zip(distinct, found, strict=True) if ids is None]:
            self.learn(new)
            found = [self.cache[w] if ids is None else ids for w, ids in zip(distinct, found, strict=True)]
        flat = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        many = lengths[each]
        ends = np.cumsum(many)
        out = flat[np.repeat(starts[each] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        data = out.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=1)
def word_ids(path, cache_words):
    import os

    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path if "/" in path else public_tokenizers.path(path), cache_words)


class LossMarks:
    """Which ids of an example bear loss: runs (length, bears loss), one after the other."""

    def __init__(self, runs):
        lengths = np.array([n for n, _ in runs], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        self.sums = np.concatenate([[0], np.cumsum([n if loss else 0 for n, loss in runs])])
        self.total = int(self.sums[-1])

    def before(self, place):
        """Ids before ``place`` that bear loss."""
        return int(np.interp(place, self.ends, self.sums))

    def after(self, place):
        """The marks of the ids from ``place`` on."""
        runs = zip(np.diff(self.ends).tolist(), np.diff(self.sums).tolist(), strict=True)
        rest, skip = [], place
        for n, loss in runs:
            if n > skip:
                rest.append((n - skip, loss > 0))
            skip = max(0, skip - n)
        return LossMarks(rest)

    def between(self, start, length):
        return self.before(start + length) - self.before(start)

    def most(self, start, length, room):
        """The largest number of ids from ``start``, up to ``length``, with loss up to ``room``."""
        limit = self.before(start) + int(room)
        run = int(np.searchsorted(self.sums, limit, side="right")) - 1
        end = int(self.ends[run]) + (limit - int(self.sums[run]))
        return max(0, min(length, end - start))


class Packer:
    """Places pieces of documents into sequences.

    Demand and limits are vectors: tokens, segments, loss-bearing tokens. A sequence takes
    the piece whose demand has the largest dot product with the room left, among those that
    fit. If none fits, or the last segment is used, the longest piece is cut to the room in
    tokens and in loss.
    """

    def __init__(self, length=LENGTH, segments=MAX_SEGMENTS, loss=MAX_LOSS):
        self.limits = np.array([length, segments, loss], np.float64)

    def pack(self, lengths, finish, marks=None):
        """Sequences as lists of (document, start, length, loss); and what is left over.

        ``marks`` has the ``LossMarks`` of each document; without, every token bears loss.
        Unless ``finish``, the last documents stay for the next block when no full
        sequence can be made of them any more.
        """
        self.marks = marks
        left = np.asarray(lengths, np.int64).copy()
        loss = left.copy() if marks is None else np.array([m.total for m in marks], np.int64)
        start, heads = np.zeros(len(left), np.int64), np.zeros(len(left))
        if marks is not None:
            heads[:] = [m.most(0, n, 0) for m, n in zip(marks, left.tolist(), strict=True)]
        cap = int(self.limits[0])
        total = int(left.sum())
        while total >= cap or (finish and total):
            made = self.one(left, loss, start, heads, min(cap, total))
            if not made:
                raise ValueError("the limits leave no room for a single token")
            yield made
            total = int(left.sum())

    def one(self, left, loss, start, heads, want):
        if want < self.limits[0]:  # the rest of a task goes to sequences of powers of two
            want = 1 << (want.bit_length() - 1)
        limits = np.array([want, *self.limits[1:]])
        used, made = np.zeros(3), []
        live = np.flatnonzero(left > 0)
        sizes = left[live].astype(np.float64)
        demands = np.stack([sizes, np.ones(len(live)), loss[live].astype(np.float64)])
        demands /= limits[:, None]
        open_ = np.ones(len(live), bool)
        while True:
            room = 1 - used / limits
            gap = int(want - used[0])
            slots = int(limits[1] - used[1])
            if gap <= 0 or slots <= 0 or not open_.any():
                break
            pick = None
            if slots > 1:
                fits = open_ & (demands <= room[:, None] + 1e-12).all(axis=0)
                if fits.any():
                    pick = int(np.argmax(np.where(fits, room @ demands, -1.0)))
                    take = int(sizes[pick])
            if pick is None:
                loss_room = int(limits[2] - used[2])
                # Without room for loss only ids in front of it can go on.
                reach = sizes if loss_room else heads[live]
                pick = int(np.argmax(np.where(open_, reach, 0)))
                take = min(gap, int(sizes[pick]))
                take = self.cut(live[pick], int(start[live[pick]]), take, loss_room)
                short = take < MIN_PIECE and take < sizes[pick] and want == self.limits[0]
                if take <= 0 or (short and made):
                    break
            at = live[pick]
            bears = take if self.marks is None else self.marks[at].between(int(start[at]), take)
            made.append((int(at), int(start[at]), take, bears))
            start[at] += take
            left[at] -= take
            loss[at] -= bears
            if self.marks is not None:
                heads[at] = self.marks[at].most(int(start[at]), int(left[at]), 0)
            used += (take, 1, bears)
            open_[pick] = False
        return made

    def cut(self, document, start, tokens, room):
        """The most tokens, up to ``tokens``, whose loss fits."""
        if self.marks is None:
            return max(0, min(tokens, int(room)))
        return self.marks[document].most(start, tokens, room)


def pack_documents(
    docs, key="doc_id", text="text", tokenizer=TOKENIZER, last_id=LAST_ID, length=LENGTH,
    max_segments=MAX_SEGMENTS, max_loss=MAX_LOSS, parts=None, block_tokens=BLOCK_TOKENS,
    cache_words=CACHE_WORDS,
):
    """Pieces of all documents with the sequence and the place they go to.

    Each task packs its own rows, block by block: it holds about ``block_tokens`` ids, puts
    them into sequences of ``length`` tokens, and takes what fills no sequence to the next
    block. Only the rest of a task goes to shorter sequences, of powers of two. No shuffle,
    no task depends on another, and no group is gathered. ``sequence_id`` is the number of
    the task and a count in it, so a repeated task makes the same rows from the same input.

    A plain text bears loss in every token, so its loss limit is the length. Instruction data
    come in ``parts``, the name of a column of arrays of (text, loss): their ids follow each
    other, and those of parts whose ``loss`` is true count against ``max_loss``, which holds
    for each sequence as the other limits do. ``last_id`` bears the loss of the last part.
    ``loss_tokens`` counts the tokens of a piece that bear loss. A worker remembers the ids of
    ``cache_words`` words, 0.2 MB a thousand, from one task to the next.

    A null or empty text, or no parts, is the id ``last_id`` alone; a null ``loss`` is false.
    Rows are packed one by one, also repeated ones and those without key. Only ``key`` and the
    results come back. An empty table gives no pieces.
    """
    kind = docs.schema[key].dataType.simpleString()
    empty = "array<struct<text:string,loss:boolean>>"
    rows = texts(docs, key, text) if parts is None else docs.select(
        name_of(key).alias("key"),
        F.transform(
            F.coalesce(name_of(parts), F.array().cast(empty)),
            lambda p: F.struct(
                F.coalesce(p["text"], F.lit("")).alias("text"), F.coalesce(p["loss"], F.lit(False)).alias("loss")
            ),
        ).alias("parts"),
    )

    def pack(batches):
        encode = word_ids(tokenizer, cache_words).encode_all
        task = TaskContext.get().partitionId() << 33
        packer = Packer(length, max_segments, max_loss)
        held, count = [], 0  # (key, ids, tokens before, tokens in all, loss marks)
        last = np.array([last_id], "<u4").tobytes()

        def place(finish):
            nonlocal held, count
            used = [0] * len(held)
            rows = []
            marks = None if parts is None else [h[4] for h in held]
            for made in packer.pack([len(h[1]) // 4 for h in held], finish, marks):
                at = 0
                size = sum(n for _, _, n, _ in made)
                for i, start, n, loss in made:
                    name, ids, before, tokens, _ = held[i]
                    piece = ids[4 * start : 4 * (start + n)]
                    crc = zlib.crc32(piece)
                    rows.append((name, before + start, n, crc, tokens, task + count, at, size, loss))
                    at, used[i] = at + n, start + n
                count += 1
            held = [
                (name, ids[4 * u :], before + u, tokens, marks and marks.after(u))
                for (name, ids, before, tokens, marks), u in zip(held, used, strict=True)
                if 4 * u < len(ids)
            ]
            return rows

        def batch_of(rows):
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], key_type)]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in COLUMNS.split(", ")])

        def examples(batch):
            """(ids, loss marks) of each row."""
            if parts is None:
                for data in encode(batch.column("text")):
                    yield data + last, None
                return
            for row in batch.column("parts").to_pylist():
                found = encode(pa.array([p["text"] for p in row], pa.string()))
                runs = [[len(d) // 4, p["loss"]] for d, p in zip(found, row, strict=True)] or [[0, False]]
                runs[-1][0] += 1
                yield b"".join(found) + last, LossMarks(runs)

        size, key_type = 0, pa.int64()
        for batch in text_batches(batches, BLOCK_BYTES, "text" if parts is None else None):
            key_type = batch.column("key").type
            for name, (data, marks) in zip(batch.column("key").to_pylist(), examples(batch), strict=True):
                held.append((name, data, 0, len(data) // 4, marks))
                size += len(data) // 4
            if size >= block_tokens:
                if rows := place(False):
                    yield batch_of(rows)
                size = sum(len(h[1]) for h in held) // 4
        if rows := place(True):
            yield batch_of(rows)

    return rows.mapInArrow(pack, COLUMNS.format(kind)).withColumnRenamed("key", key)


def op2_packing(spark, sf_dir):
    """Pieces of every document in sequences of at most 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs)
