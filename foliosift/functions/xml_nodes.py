"""XML text to node lists: the one step that leaves the JVM.

Spark's XML reader loses the order between headings and paragraphs and its ``xpath``
functions fail the query on a malformed document, so parsing runs in Arrow batches.
Only the XML column crosses to the Python worker, which holds trees and nodes of a bounded
slice of a batch at a time, whatever the session allows a batch.
"""

from collections.abc import Iterator
from xml.etree.ElementTree import ParseError, fromstring

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.functions.nodes import DOCUMENT_CODE, HEADING, PARAGRAPH
from foliosift.schemas import PARSED_XML

# Bytes of XML that are parsed together; a larger document makes a slice of its own.
SLICE_BYTES = 1 << 20


def _xml_parser():
    # All names are local, so that the function travels to the workers by value and
    # they need no copy of this package.
    heading = f"{{{V.COMMON_NAMESPACE}}}{HEADING}"
    names = {f"{{{V.COMMON_NAMESPACE}}}{name}": name for name in (PARAGRAPH, DOCUMENT_CODE)}
    names[heading] = HEADING
    id_name = f"{{{V.ID_NAMESPACE}}}id"
    node_type = pa.struct(
        [
            ("pos", pa.int32()),
            ("root_child", pa.bool_()),
            ("tag", pa.string()),
            ("node_id", pa.string()),
            ("text", pa.string()),
            ("tails", pa.list_(pa.string())),
            ("full_text", pa.string()),
        ]
    )
    parse, failure, most = fromstring, ParseError, SLICE_BYTES

    def slices(documents):
        start = size = 0
        for at, length in enumerate(pc.binary_length(documents).to_pylist()):
            length = length or 0
            if at > start and size + length > most:
                yield documents.slice(start, at - start)
                start, size = at, 0
            size += length
        yield documents.slice(start)

    def nodes(root):
        # Named elements anywhere below the root, and whatever stands directly below it.
        children = {id(child) for child in root}
        for pos, element in enumerate(root.iter()):
            is_child = id(element) in children
            name = names.get(element.tag)
            if pos and (name or is_child):
                yield (
                    pos,
                    is_child,
                    name or element.tag,
                    element.get(id_name),
                    element.text,
                    [child.tail for child in element if child.tail],
                    "".join(element.itertext()) if element.tag == heading else None,
                )

    def parsed_slice(documents):
        errors, rows, starts = [], [], [0]
        missing = []
        for document in documents:
            error = None
            if document.is_valid:
                try:
                    rows.extend(nodes(parse(document.as_py())))
                except failure as reason:
                    error = f"malformed XML: {reason}"
            errors.append(error)
            missing.append(error is not None or not document.is_valid)
            starts.append(len(rows))
        columns = list(zip(*rows)) or [()] * node_type.num_fields
        fields = [pa.array(list(c), type=f.type) for c, f in zip(columns, node_type)]
        lists = pa.ListArray.from_arrays(
            pa.array(starts, pa.int32()),
            pa.StructArray.from_arrays(fields, fields=list(node_type)),
            mask=pa.array(missing, pa.bool_()),
        )
        return pa.StructArray.from_arrays(
            [pa.array(errors, pa.string()), lists], ["error", "nodes"]
        )

    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for documents in batches:
            for part in slices(documents):
                yield parsed_slice(part)

    return parsed


# Node list of each document, or the reason why it has none. Parsing costs far more than any
# filter saves, so no copy of it may go below one that looks at its result.
parsed_xml = F.arrow_udf(_xml_parser(), PARSED_XML).asNondeterministic()
