"""SQL on the node list of one XML document.

A node list never leaves its row. All rules on it are array expressions, so finding
headings and sections needs no shuffle and one document is never spread over rows
that would have to be grouped again.
"""

from foliosift.functions.ids import has_id, id_number
from foliosift.functions.text import literal, stripped

HEADING = "Heading"
PARAGRAPH = "P"
DOCUMENT_CODE = "DocumentCode"


def heading_text(full_text):
    return f"upper({stripped(full_text)})"


def direct_text(text, tails, separator):
    """Own text and the text after each child, without what the children hold."""
    # Most elements have no tails, and then nothing needs joining.
    joined = f"array_join(array_prepend({tails}, {text}), {literal(separator)})"
    return f"if(size({tails}) > 0, {joined}, coalesce({text}, ''))"


def headings(nodes="nodes"):
    """Headings in document order as (node_id, words), words in upper case."""
    return (
        f"transform(filter({nodes}, n -> n.tag = '{HEADING}'), "
        f"n -> named_struct('node_id', n.node_id, 'words', {heading_text('n.full_text')}))"
    )


def children(nodes="nodes"):
    """Direct children of the document element that carry an id, with its number.

    Only a broken id leaves a child without a number.
    """
    return (
        f"transform(filter({nodes}, n -> n.root_child and {has_id('n.node_id')}), "
        f"n -> named_struct('pos', n.pos, 'num', {id_number('n.node_id')}, "
        "'text', n.text, 'tails', n.tails))"
    )


def _headings_with(word, without, found):
    test = f"contains(h.words, {literal(word)})"
    if without:
        test += f" and not contains(h.words, {literal(without)})"
    return f"filter({found}, h -> {test})"


def first_heading_id(word, without=None, found="headings"):
    """Id of the first heading holding ``word``; null also where that heading has none."""
    return f"try_element_at({_headings_with(word, without, found)}, 1).node_id"


def last_heading_id(word, without=None, found="headings"):
    """Id of the last heading holding ``word``; null also where that heading has none."""
    return f"try_element_at({_headings_with(word, without, found)}, -1).node_id"


def longer_when_stripped(text, longer_than):
    # Stripping only shortens, so the plain length settles most texts.
    return f"(length({text}) > {longer_than} and length({stripped(text)}) > {longer_than})"


def first_long_paragraph(longer_than, nodes="nodes"):
    """Text of the first paragraph, at any depth, that is long enough when stripped."""
    texts = (
        f"transform(filter({nodes}, n -> n.tag = '{PARAGRAPH}'), "
        f"n -> {direct_text('n.text', 'n.tails', '')})"
    )
    return f"try_element_at(filter({texts}, t -> {longer_when_stripped('t', longer_than)}), 1)"


def document_code(nodes="nodes"):
    """Text of the first document code element."""
    return f"try_element_at(filter({nodes}, n -> n.tag = '{DOCUMENT_CODE}'), 1).text"
