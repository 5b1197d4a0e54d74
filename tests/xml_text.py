"""Small XML documents for the tests."""

from xml.sax.saxutils import escape

from foliosift import fixed_values as V

START = (
    f'{V.DOCUMENT_START} xmlns:uspat="{V.DOCUMENT_NAMESPACE}" '
    f'xmlns:uscom="{V.COMMON_NAMESPACE}" xmlns:com="{V.ID_NAMESPACE}">'
)


def element(tag, node_id, text, inside=""):
    name = f' com:id="{node_id}"' if node_id is not None else ""
    return f"<uscom:{tag}{name}>{escape(text)}{inside}</uscom:{tag}>"


def heading(node_id, text, inside=""):
    return element("Heading", node_id, text, inside)


def paragraph(node_id, text, inside=""):
    return element("P", node_id, text, inside)


def document(*elements):
    return V.XML_DECLARATION + START + "".join(elements) + V.DOCUMENT_END


def words(length, start="w"):
    """Text of exactly ``length`` characters without white space at its ends."""
    return (start + " words and more" * (length // 10 + 1))[: length - 1] + "."
