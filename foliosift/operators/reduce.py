"""From the texts of many documents to one row for each application."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.session import written

# Fixed value: positions are below this, so that a length and a position make one number.
POSITIONS = 2**63

# Column that counts the listed documents of an application that have not landed.
MISSING = "payloads_missing"
# Which texts a document type supplies.
TEXTS_OF_TYPE = {"ABST": ["abstract"], "SPEC": ["background", "summary"]}


def longest(text, *order, where=None):
    """Aggregate: the longest text, the first by ``order`` among equally long ones."""
    rank = F.struct(F.length(text).alias("n"), *((-column) for column in order))
    if where is not None:
        rank = F.when(where, rank)
    return F.max_by(text, rank)


def longest_texts(rows, keys, texts, *order):
    """The longest of each text column for each key; ``""`` where there is none."""
    best = (F.coalesce(longest(F.col(t), *order), F.lit("")).alias(t) for t in texts)
    return rows.groupBy(*keys).agg(*best)


def before_stop(
    files,
    key="application_number",
    seq="seq",
    doc_type="doc_type",
    lengths=None,
    at_least=V.LONG_ENOUGH,
):
    """Drop the files that come after the texts of their type are long enough.

    ``lengths`` names, for each type, the length columns of its texts. A type is done
    at the first file by which every one of its texts has reached ``at_least``; later
    files of that type go. The stops come from one combining aggregation, and only keys
    with something to drop get one. ``files`` should be stored and hold no texts: then AQE
    splits the files of a key that most of them share.
    """
    lengths = lengths or {t: [f"len_{c}" for c in cs] for t, cs in TEXTS_OF_TYPE.items()}
    stop = F.lit(None)
    for kind, columns in lengths.items():
        reached = [F.min(F.when(F.col(c) >= at_least, F.col(seq))) for c in columns]
        done = reduce(and_, (first.isNotNull() for first in reached))
        last = F.greatest(*reached) if len(reached) > 1 else reached[0]
        stop = F.when((F.col(doc_type) == kind) & done, last).otherwise(stop)
    stops = (
        files.groupBy(F.col(key).alias("_key"), F.col(doc_type).alias("_type"))
        .agg(stop.alias("_stop"), F.max(seq).alias("_last"))
        .filter("_stop < _last")
        .select("_key", "_type", "_stop")
    )
    too_late = (
        (F.col(key) == F.col("_key"))
        & (F.col(doc_type) == F.col("_type"))
        & (F.col(seq) > F.col("_stop"))
    )
    return files.join(written(stops, "stops"), too_late, "left_anti")


def winners(kept, key="application_number", seq="seq", doc_type="doc_type"):
    """(key, text, seq): the file that has the longest of each text, the first of equals.

    Looks at lengths and positions only. Both make up one number, so the aggregation keeps
    numbers and needs no sort. A text that no file supplies has a null position.
    """
    best = []
    for kind, texts in TEXTS_OF_TYPE.items():
        for text in texts:
            rank = F.expr(
                f"cast(len_{text} as decimal(10,0)) * {POSITIONS}BD + ({POSITIONS - 1}BD - {seq})"
            )
            own = (F.col(doc_type) == kind) & (F.col(f"len_{text}") > 0)
            best.append(F.max(F.when(own, rank.cast("decimal(38,0)"))).alias(text))
    ranks = kept.groupBy(key).agg(*best)
    place = lambda t: F.expr(f"cast({POSITIONS - 1}BD - {t} % {POSITIONS}BD as bigint)")
    rows = F.array(
        *(F.struct(F.lit(t).alias("text"), place(t).alias(seq)) for ts in TEXTS_OF_TYPE.values() for t in ts)
    )
    return ranks.select(key, F.inline(rows))


def best_texts(kept, key="application_number", seq="seq", doc_type="doc_type"):
    """Longest abstract, background and summary of each key, each from its own type.

    Every key gets a row; a text that no file supplies is ``""``.
    """
    columns = []
    for kind, texts in TEXTS_OF_TYPE.items():
        for text in texts:
            own = F.when(F.col(doc_type) == kind, F.col(text))
            columns.append(F.coalesce(longest(own, F.col(seq)), F.lit("")).alias(text))
    return kept.groupBy(key).agg(*columns)


def attached(apps, texts, key="application_number"):
    """Each application with its texts; null texts where it has no row in ``texts``.

    Keeps every input row. ``payloads_missing`` tells how many listed documents of the
    application have not landed; 0 where there is no row. With ``texts`` a stored table, AQE
    splits the copies of a key that many rows share.
    """
    names = [name for name in ("abstract", "summary", "background") if name in texts.columns]
    found = apps.join(texts.select(key, *names, *(c for c in [MISSING] if c in texts.columns)), key, "left")
    missing = [F.coalesce(MISSING, F.lit(0)).cast("bigint").alias(MISSING)]
    return found.select(*apps.columns, *names, *(missing if MISSING in texts.columns else []))
