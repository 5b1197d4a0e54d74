"""Line dedup: lines that several documents hold stay in the first of them only."""

from pyspark.sql import functions as F

from foliosift.llm.common import lowered, packed, with_columns
from foliosift.session import written

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line):
    """The line without blanks at its ends, A-Z in lower case."""
    return lowered(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs, key="doc_id", text="text", min_chars=10, max_docs=1):
    """``docs`` with repeated lines dropped from ``text``, and ``n_lines``, ``n_dropped``.

    Lines are exploded as fingerprints of 128 bits, never as texts. A key of at least
    ``min_chars`` code points in more than ``max_docs`` documents loses all its lines but
    those of its smallest document. The positions to drop meet the document in one join
    and the rest is put together by position. The repeated keys are stored first, so
    that AQE can split the lines of a very common key.

    A null or empty text is one empty line. A text in which nothing is dropped stays the
    same to the byte. Rows of one document id are one document; a row without id keeps
    all its lines and counts for none. Other columns stay; columns named ``n_lines`` or
    ``n_dropped`` are replaced. An empty table gives an empty result.
    """
    base = packed(docs, key, text).select("*", F.xxhash64("text").alias("own"))
    keys = F.transform(F.split("text", "\n"), line_key)
    lines = base.select("key", "own", F.posexplode(keys).alias("pos", "line")).filter(
        F.length("line") >= min_chars
    )
    marks = lines.select(
        "key",
        "own",
        "pos",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )
    common = marks.groupBy("h1", "h2").agg(
        F.count_distinct("key").alias("docs"), F.min("key").alias("first")
    )
    common = written(common.filter(F.col("docs") > max_docs).drop("docs"), "lines")
    dropped = (
        marks.join(common, ["h1", "h2"])
        .filter(F.col("key") != F.col("first"))
        .groupBy("key", "own")
        .agg(F.collect_list("pos").alias("gone"))
    )
    found = base.join(dropped, ["key", "own"], "left")
    split = F.split("text", "\n")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone)
    found = found.select("*", split.alias("lines"), places.alias("places"))
    kept = F.array_join(F.transform("places", lambda i: F.col("lines")[i]), "\n")
    return with_columns(
        found,
        {
            text: kept,
            "n_lines": F.size("lines").cast("bigint"),
            "n_dropped": (F.size("lines") - F.size("places")).cast("bigint"),
        },
        docs.columns,
    )


def op1_line_dedup(spark, sf_dir):
    """Every document's lines, dropped lines and digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


OP1_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), common as (
  select k, min(doc_id) as first from keyed where length(k) >= 10
  group by k having count(distinct doc_id) >= 2
), marked as (
  select keyed.*, coalesce(keyed.doc_id <> common.first, false) as gone
  from keyed left join common using (k)
)
select doc_id, cast(count(*) as bigint) as n_lines,
  cast(count(*) filter (where gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), ''))
    as kept_sha256
from marked group by doc_id
"""
