"""Give each application its abstract, background and summary."""

from collections import namedtuple

from pyspark.sql import functions as F

from foliosift.operators.documents import document_nodes, payload_documents
from foliosift.operators.reduce import (
    MISSING,
    TEXTS_OF_TYPE,
    attached,
    before_stop,
    longest_texts,
    winners,
)
from foliosift.operators.references import listed_documents, xml_references
from foliosift.operators.sections import indexed, with_abstract, with_spec_sections
from foliosift.session import written

TEXTS = ["abstract", "background", "summary"]
ERROR_OF_TYPE = {"ABST": "abstract_error", "SPEC": "spec_error"}
ERRORS = ["xml_error", *ERROR_OF_TYPE.values()]
NOT_LANDED = "payload missing"

# ``texts``: the applications with their texts; ``pieces``: what was parsed, with what went
# wrong; ``missing``: listed URLs whose payload has not landed.
Enriched = namedtuple("Enriched", "texts pieces missing")


def wanted_payloads(references):
    """(url, wants_ABST, wants_SPEC): which rules the references to a URL ask for."""
    wants = (F.bool_or(F.col("doc_type") == kind).alias(f"wants_{kind}") for kind in TEXTS_OF_TYPE)
    return references.groupBy("url").agg(*wants)


def piece_texts(documents):
    """Texts of each XML document (url, piece, xml) and what went wrong with it.

    Where ``documents`` says which types refer to it, only their rules run, and only their
    errors count.
    """
    found = with_spec_sections(with_abstract(indexed(document_nodes(documents))))
    for kind, texts in TEXTS_OF_TYPE.items():
        if f"wants_{kind}" in documents.columns:
            own = [*texts, ERROR_OF_TYPE[kind]]
            found = found.withColumns({c: F.when(F.col(f"wants_{kind}"), F.col(c)) for c in own})
    lengths = (F.length(text).alias(f"len_{text}") for text in TEXTS)
    return found.select("url", "piece", *TEXTS, *lengths, *ERRORS)


def quarantined(found):
    """What could not be used: (url, piece, stage, reason).

    ``found`` is the result of ``enriched`` or a table of pieces. A payload that is listed but
    has not landed has no piece.
    """
    pieces = found.pieces if isinstance(found, Enriched) else found
    stages = (
        F.struct(F.lit(name.removesuffix("_error")).alias("stage"), F.col(name).alias("reason"))
        for name in ERRORS
    )
    rows = pieces.select("url", "piece", F.inline(F.array(*stages))).filter("reason is not null")
    if not isinstance(found, Enriched):
        return rows
    piece = F.lit(None).cast("int").alias("piece")
    absent = found.missing.select("url", piece, F.lit("payload").alias("stage"), F.lit(NOT_LANDED).alias("reason"))
    return rows.unionByName(absent)


def finished(texts):
    """Enriched rows whose listed documents have all landed; the others stay pending."""
    return texts.filter(F.col(MISSING) == 0)


def file_texts(pieces):
    """Longest texts of each URL over its documents, with their lengths."""
    longest = longest_texts(pieces, ["url"], TEXTS, F.col("piece"))
    return longest.withColumns({f"len_{text}": F.length(text) for text in TEXTS})


def application_texts(references, files):
    """Best texts of each application that has an XML reference.

    Stops and winners follow from lengths and positions alone, which meet the references
    once. Only then the texts of at most three winning files for each application are
    fetched. ``files`` should be a stored table: it is read twice, and a plain table lets AQE
    split the references to a URL that very many applications share.
    """
    lengths = files.select("url", *(f"len_{text}" for text in TEXTS))
    columns = ["application_number", "url", "seq", "doc_type"]
    sized = written(references.select(*columns).join(lengths, "url", "left"), "sized")
    won = written(winners(before_stop(sized)), "winners")
    places = won.filter("seq is not null").join(
        sized.select("application_number", "seq", "url"), ["application_number", "seq"]
    )
    places = places.groupBy("application_number", "text").agg(F.min("url").alias("url"))
    value = F.element_at(F.create_map(*(x for t in TEXTS for x in (F.lit(t), F.col(t)))), F.col("text"))
    texts = written(places, "places").join(files.select("url", *TEXTS), "url")
    entry = F.struct("text", value.alias("value"))
    texts = texts.groupBy("application_number").agg(F.map_from_entries(F.collect_list(entry)).alias("_texts"))
    every = won.select("application_number").distinct()
    found = every.join(texts, "application_number", "left")
    return found.select(
        "application_number", *(F.coalesce(F.col("_texts")[t], F.lit("")).alias(t) for t in TEXTS)
    )


def referred(apps, listings, payloads):
    """XML references of ``apps``, stored, and whether the payload of each has landed."""
    wanted = written(apps.select("application_number").distinct(), "wanted")
    references = xml_references(listed_documents(listings))
    references = written(references.join(wanted, "application_number", "left_semi"), "references")
    landed = payloads.select(F.col("url").alias("_landed")).filter("_landed is not null").distinct()
    found = references.join(written(landed, "landed"), F.col("url") == F.col("_landed"), "left")
    return written(found.withColumn("landed", F.col("_landed").isNotNull()).drop("_landed"), "referred")


def enriched(apps, listings, payloads):
    """``apps`` with their texts, and what was parsed and what is missing behind them.

    Three states of a listed document stay apart. Not listed: the texts are null. Listed but
    not landed: it adds no text, counts in ``payloads_missing`` and goes to quarantine, so that
    the application stays pending. Landed: a text that is not found in it is empty.

    Only payloads that these applications refer to are parsed, each once, and only the rules
    of the types that refer to it run. What later steps read more than once, or join, is
    written to the shared folder first: its size is then known when joins are planned, and
    a lost executor repeats no parsing.
    """
    references = referred(apps, listings, payloads)
    there = references.filter("landed")
    asked = payloads.join(written(wanted_payloads(there), "asked"), "url")
    pieces = written(piece_texts(payload_documents(asked)), "pieces")
    files = written(file_texts(pieces), "files")
    counts = references.groupBy("application_number").agg(F.count_if(~F.col("landed")).alias(MISSING))
    texts = counts.join(application_texts(there, files), "application_number", "left")
    missing = references.filter("not landed").select("url").distinct()
    return Enriched(attached(apps, written(texts, "texts")), pieces, missing)
