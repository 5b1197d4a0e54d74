"""Secret scans: patterns, and strings that a vocabulary spells with too many tokens."""

import base64
import functools
import re

import pyarrow as pa
from pyspark.sql import functions as F

from foliosift.llm.common import byte_texts, code_points, row_batches, texts

# The kinds with their patterns and least lengths.
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LONG_HEX = re.compile(rb"[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex", "token"]
MIN_ASSIGN, MIN_ACCESS = 12, 18

# Strings worth the token test, and those that are known not to be secrets.
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(rb"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}"
                    rb"|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")  # fmt: skip
UUID = re.compile(rb"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PART = re.compile(rb"[^+/_=-]+")
KNOWN_INSIDE = re.compile(rb"(?<![^/=_-])(?:" + UUID.pattern + rb"|" + DIGEST.pattern + rb")(?![^/=_-])")
WORDS = re.compile(rb"[+/_=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[+/_=-]+|\Z))+")
VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_CHARS_PER_TOKEN = 2.0
MIN_RANDOM = 20
# Bytes that the vocabulary is asked about at a time.
ENCODED = 4096

COLUMNS = "key {}, n_assign long, n_access long, n_hex long, n_token long, base string, spans string"


@functools.lru_cache(maxsize=4)
def encoding(path):
    """The tiktoken vocabulary of a file; ``path`` may be a name of the public ones."""
    import public_tokenizers
    import tiktoken

    path = path if "/" in path else public_tokenizers.path(path)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def token_count(word, vocabulary):
    encode = encoding(vocabulary).encode_ordinary
    text = word.decode()
    return sum(len(encode(text[i : i + ENCODED])) for i in range(0, len(text), ENCODED))


def surplus(part, vocabulary, most):
    """Characters that the tokens of a part fall short of; none for words and numbers."""
    tokens = token_count(part, vocabulary)
    if part.isdigit() or tokens == 1:
        return min(-1, most * tokens - len(part))
    return most * tokens - len(part)


def is_known(word, vocabulary=VOCABULARY, most=MAX_CHARS_PER_TOKEN):
    """Digests, UUIDs, and identifiers whose parts are all numbers or tokenise as words."""
    if DIGEST.fullmatch(word) or UUID.fullmatch(word):
        return True
    if not WORDS.fullmatch(word):
        return False
    return all(surplus(part, vocabulary, most) <= 0 for part in PART.findall(word))


def base_spans(data):
    """(start, kind, end) in bytes of the base patterns."""
    found = []
    low = data.lower()
    if any(word in low for word in (b"passw", b"secret", b"token", b"api")):
        for m in ASSIGN.finditer(data):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found.append((m.start(), 0, m.end()))
    if b"AKIA" in data:
        for m in ACCESS.finditer(data):
            if m.end() - m.start() >= MIN_ACCESS:
                found.append((m.start(), 1, m.end()))
    found += ((m.start(), 2, m.end()) for m in LONG_HEX.finditer(data))
    return found


def random_stretches(word, vocabulary, most):
    """(start, end) of stretches of parts that have too many tokens, in one pass.

    A part that tokenises as words lowers the sum of its stretch; a stretch ends where the
    sum falls below zero, and reaches up to its highest sum. Digests and UUIDs between marks
    separate stretches.
    """
    known = [m.span() for m in KNOWN_INSIDE.finditer(word)]
    parts, at = [], 0
    for m in PART.finditer(word):
        while at < len(known) and known[at][1] <= m.start():
            at += 1
        inside = at < len(known) and known[at][0] <= m.start()
        parts.append((m.start(), m.end(), None if inside else surplus(m.group(), vocabulary, most)))
    start, end, total, best = None, 0, 0, 0
    for first, last, extra in [*parts, (0, 0, None)]:
        if extra is None or total + extra < 0:
            if best > 0 and end - start >= MIN_RANDOM:
                yield start, end
            start, total, best = None, 0, 0
            continue
        if start is None:
            start = first
        total += extra
        if total >= best:
            best, end = total, last


def random_spans(data, vocabulary, most=MAX_CHARS_PER_TOKEN):
    """(start, kind, end) of long strings with few characters for each token.

    Where a whole run has enough characters for each token, its parts between marks are
    tested, alone and with their neighbours.
    """
    for m in CANDIDATE.finditer(data):
        word = m.group()
        if is_known(word, vocabulary, most):
            continue
        if len(word) < most * token_count(word, vocabulary):
            yield (m.start(), 3, m.end())
        else:
            for start, end in random_stretches(word, vocabulary, most):
                yield (m.start() + start, 3, m.start() + end)


def spelled(data, spans):
    """kind:start:end in code points, by start and then by kind."""
    parts, seen, at = [], 0, 0
    ascii_only = data.isascii()
    for start, kind, end in sorted(spans):
        if not ascii_only:
            at += code_points(data[seen:start])
            seen, length = start, code_points(data[start:end])
        else:
            at, length = start, end - start
        parts.append(f"{KINDS[kind]}:{at}:{at + length}")
    return ",".join(parts)


def find_secrets(
    docs, key="doc_id", text="text", vocabulary=VOCABULARY, max_chars_per_token=MAX_CHARS_PER_TOKEN
):
    """Secrets of each document: counts by kind, base spans and all spans.

    Base patterns: assignments, access keys and hexadecimal runs. The token test adds runs
    of at least 20 characters that take a token for fewer than ``max_chars_per_token``
    characters, unless they are digests, UUIDs, numbers, or identifiers whose parts tokenise
    as words. In a longer run the stretches of its parts between marks are tested as well. It
    looks at single runs, so a text costs no more than one scan. No shuffle.

    A null or empty text has no spans (empty strings, zero counts); a null key stays null.
    Rows are independent: repeated rows repeat their result, and only ``key`` and the
    results come back. Spans of one start come in the order of the kinds.
    """
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches):
        for batch in row_batches(batches):
            rows = []
            for data in byte_texts(batch):
                base = base_spans(data)
                spans = base + list(random_spans(data, vocabulary, max_chars_per_token))
                counts = [sum(s[1] == k for s in spans) for k in range(4)]
                rows.append((*counts, spelled(data, base), spelled(data, spans)))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
            arrays += [pa.array(c, pa.string()) for c in columns[4:]]
            names = ["key", "n_assign", "n_access", "n_hex", "n_token", "base", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], names)

    found = texts(docs, key, text).mapInArrow(scan, COLUMNS.format(kind))
    return found.withColumnRenamed("key", key)


def op3_secret_scan(spark, sf_dir):
    """Spans of secrets in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs)
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"),
        "spans", "n_token",
    )
