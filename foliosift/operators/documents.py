"""Payload bytes to XML documents to node lists. Every step is map-only."""

from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.functions.payload import cut, decoded, has_doctype, restored, starts_document
from foliosift.functions.xml_nodes import parsed_xml


def split_payloads(payloads, text, start=V.XML_DECLARATION, end=V.DOCUMENT_END, name="xml"):
    """One row for each piece of ``text`` that begins with ``start``.

    A piece ends at its first ``end``; text before the first ``start`` is dropped.
    ``piece`` numbers the pieces of a payload from 0.
    """
    others = [c for c in payloads.columns if c != text]
    parts = payloads.select(*others, F.posexplode(cut(F.col(text), start)).alias("_at", "_part"))
    return parts.filter("_at > 0").select(
        *others, (F.col("_at") - 1).alias("piece"), restored(F.col("_part"), start, end).alias(name)
    )


def payload_documents(payloads):
    """One row (url, piece, xml) for each specification document of each payload.

    Other columns of the payload stay with its documents.
    """
    others = [name for name in payloads.columns if name != "content"]
    texts = payloads.select(*others, decoded(F.col("content")).alias("_text"))
    return split_payloads(texts, "_text").filter(starts_document(F.col("xml")))


def document_nodes(documents):
    """Replace ``xml`` by ``xml_error`` and ``nodes``.

    Payloads are untrusted, so a document that declares a document type is not parsed.
    """
    safe = documents.withColumn("_declares", has_doctype(F.col("xml")))
    parsed = safe.withColumn("_parsed", parsed_xml(F.when(~F.col("_declares"), F.col("xml"))))
    return parsed.select(
        *(name for name in documents.columns if name != "xml"),
        F.when(F.col("_declares"), F.lit("document type declared"))
        .otherwise(F.col("_parsed.error"))
        .alias("xml_error"),
        F.col("_parsed.nodes").alias("nodes"),
    )


def node_rows(documents, nodes="nodes"):
    """The node list in long form: one row for each element in document order."""
    others = [name for name in documents.columns if name != nodes]
    return documents.select(*others, F.inline(nodes))
