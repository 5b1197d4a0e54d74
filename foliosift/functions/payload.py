"""Column helpers that turn payload bytes into XML documents."""

from pyspark.sql import functions as F

from foliosift import fixed_values as V


def decoded(content):
    """Bytes to text: UTF-8 where valid, otherwise one character for each byte."""
    return F.coalesce(
        F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")
    )


def cut(text, start=V.XML_DECLARATION):
    """``text`` cut at every ``start``; the first part lies before any of them."""
    return F.split(text, "\\Q" + start + "\\E")


def restored(part, start=V.XML_DECLARATION, end=V.DOCUMENT_END):
    """A part up to its first ``end``, with ``start`` and ``end`` put back."""
    return F.concat(F.lit(start), F.substring_index(part, end, 1), F.lit(end))


def starts_document(piece, marker=V.DOCUMENT_START, within=V.DOCUMENT_START_WITHIN):
    """True where the document element begins within the first characters."""
    return F.contains(F.left(piece, F.lit(within)), F.lit(marker))


def has_doctype(piece):
    """True where a document type declaration precedes the document element."""
    return piece.rlike(r"(?s)\A(?>\s*+(?><\?.*?\?>|<!--.*?-->))*+\s*+<!DOCTYPE")
