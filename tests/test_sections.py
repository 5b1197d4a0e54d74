import random
import re

import pyarrow as pa
import pytest
from foliosift import fixed_values as V
from foliosift.catalogue.queries import xml_document_code
from foliosift.functions.nodes import document_code
from foliosift.functions.xml_nodes import SLICE_BYTES, _xml_parser
from foliosift.operators.documents import document_nodes, node_rows, payload_documents
from foliosift.operators.sections import BROKEN_ID, indexed, with_spec_sections
from foliosift.plans.enrichment import piece_texts, quarantined
from pyspark.util import PythonEvalType
from xml_text import START, document, element, heading, paragraph, words


def texts(spark, *documents):
    payloads = [(str(n), text.encode()) for n, text in enumerate(documents)]
    frame = spark.createDataFrame(payloads, "url string, content binary")
    rows = piece_texts(payload_documents(frame)).collect()
    return [row for row in sorted(rows, key=lambda row: (int(row.url), row.piece))]


def test_abstract_rules(spark):
    long, longer = words(101, "first"), words(150, "second")
    cases = {
        "short then long": (
            [heading("h-1", "Abstract"), paragraph("p-2", words(100)), paragraph("p-3", long)],
            long,
        ),
        "number not behind": (
            [heading("h-3", "ABSTRACT"), paragraph("p-3", longer), paragraph("p-4", long)],
            long,
        ),
        "no id on heading": ([heading(None, "ABSTRACT"), paragraph("p-0", words(51))], words(51)),
        "empty id on heading": ([heading("", "ABSTRACT"), paragraph("p-0", words(51))], words(51)),
        "first heading counts": (
            [heading("h-9", "ABSTRACT"), heading("h-1", "ABSTRACT"), paragraph("p-2", words(60))],
            words(60),
        ),
        "heading without dash is 0": (
            [heading("h", "ABSTRACT"), paragraph("p", longer), paragraph("p-1", long)],
            long,
        ),
        "text in nested markup": (
            [heading("h-1", "", "<uscom:B> ab</uscom:B>stract"), paragraph("p-2", long)],
            long,
        ),
        "parts are joined by a space": (
            [
                heading("h-1", "ABSTRACT"),
                paragraph("p-2", " " + words(60), f"<uscom:B>gone</uscom:B>{words(60)} "),
            ],
            words(60) + " " + words(60),
        ),
        "fallback joins by nothing": (
            [paragraph(None, words(30), f"<uscom:B>gone</uscom:B>{words(30)}")],
            words(30) + words(30),
        ),
        "fallback needs more than 50": ([paragraph("p-1", words(50))], None),
        "fallback after no hit": (
            [heading("h-1", "ABSTRACT"), paragraph("p-2", words(70))],
            words(70),
        ),
        "fallback finds nested": ([element("Box", None, "", paragraph(None, words(51)))], words(51)),
        "any child may hold it": ([heading("h-1", "ABSTRACT"), element("Q", "q-2", long)], long),
        "nothing": ([heading("h-1", "ABSTRACT")], None),
    }
    rows = texts(spark, *(document(*elements) for elements, _ in cases.values()))
    found = dict(zip(cases, (row.abstract for row in rows)))
    assert found == {name: expected for name, (_, expected) in cases.items()}
    assert all(row.abstract_error is None for row in rows)


def test_broken_ids(spark):
    long = words(120)
    rows = texts(
        spark,
        document(heading("h-x", "ABSTRACT"), paragraph("p-2", long)),
        document(heading("h-1", "ABSTRACT"), paragraph("p-x", "a"), paragraph("p-2", long)),
        document(heading("h-1", "ABSTRACT"), paragraph("p-2", long), paragraph("p-x", "a")),
        document(paragraph("p-x", long)),
        document(heading("h-1", "SUMMARY"), paragraph("p-2", long), paragraph("p-", "a")),
        document(element("Box", None, "", heading("h-x", "SUMMARY")), paragraph("p-2", long)),
    )
    assert [row.abstract for row in rows] == [None, None, long, long, long, long]
    errors = [row.abstract_error for row in rows]
    assert errors == [BROKEN_ID, BROKEN_ID, None, None, None, None]
    assert [row.spec_error for row in rows] == [BROKEN_ID] * 6
    assert all(row.summary is None and row.background is None for row in rows)


def sections(spark, *documents):
    return [(row.background, row.summary) for row in texts(spark, *documents)]


def numbered(first, count, length=50):
    return [paragraph(f"p-{first + n}", words(length, f"t{n}")) for n in range(count)]


def test_section_rules(spark):
    a, b = words(50, "a"), words(60, "b")
    s, g = lambda n: heading(f"h-{n}", "Summary of it"), lambda n: heading(f"h-{n}", "background")
    short = lambda n: paragraph(f"p-{n}", words(49))
    cases = {
        "summary alone": ([s(1), paragraph("p-2", a), paragraph("p-3", b)], ("", f"{a} {b}")),
        "background alone": ([g(1), paragraph("p-2", a)], (a, "")),
        "background first": ([g(1), paragraph("p-2", a), s(3), paragraph("p-4", b)], (a, b)),
        "summary first": ([s(1), paragraph("p-2", a), g(3), paragraph("p-4", b)], (b, a)),
        "zero is no first": ([g(0), paragraph("p-1", a), s(1), paragraph("p-2", b)], ("", b)),
        "equal numbers": ([g(1), s(1), paragraph("p-2", a), short(3), paragraph("p-4", b)], (b, a)),
        "both words": ([heading("h-1", "BACKGROUND AND SUMMARY"), paragraph("p-2", a)], ("", a)),
        "last heading counts": ([s(1), paragraph("p-2", a), s(3), paragraph("p-4", b)], ("", b)),
        "last one without id": ([s(1), paragraph("p-2", a), heading(None, "SUMMARY")], ("", "")),
        "no dash in heading": ([heading("h1", "SUMMARY"), paragraph("p-2", a)], ("", "")),
        "number 0 heading": ([s(0), paragraph("p-1", a)], ("", a)),
        "white space ends": ([s(1), paragraph("p-2", a), paragraph("p-3", " "), paragraph("p-4", b)], ("", a)),
        "no text is skipped": ([s(1), paragraph("p-2", a), paragraph("p-3", ""), paragraph("p-4", b)], ("", f"{a} {b}")),
        "no id is skipped": ([s(1), paragraph(None, "x"), paragraph("p-4", b)], ("", b)),
        "tails are left out": ([s(1), paragraph("p-2", a, f"<uscom:B>x</uscom:B>{b}")], ("", a)),
        "bracket does not matter": ([s(1), paragraph("p-2", "[0001] x"), paragraph("p-3", a)], ("", "")),
        "ender is not reused": ([g(1), paragraph("p-2", a), s(3), paragraph("p-4", b), short(5)], (a, b)),
        "second needs an end": ([s(1), paragraph("p-2", a), paragraph("p-9", b), g(5)], ("", f"{a} {b}")),
        "nothing": ([paragraph("p-2", a)], ("", "")),
    }
    found = sections(spark, *(document(*elements) for elements, _ in cases.values()))
    assert dict(zip(cases, found)) == {name: expected for name, (_, expected) in cases.items()}


@pytest.mark.parametrize("count", [9, 10, 11, 12])
def test_at_most_ten_paragraphs(spark, count):
    kept = " ".join(words(50, f"t{n}") for n in range(min(count, 10)))
    plain = document(heading("h-1", "SUMMARY"), *numbered(2, count))
    tail = words(70, "tail")
    both = document(
        heading("h-1", "SUMMARY"), *numbered(2, count), heading("h-1", "BACKGROUND"), paragraph("p-90", tail)
    )
    # Heading numbers that do not lie behind are skipped, so only the eleventh long
    # paragraph can end the summary here.
    ended = count > 10
    rest = " ".join([*(words(50, f"t{n}") for n in range(11, count)), tail]) if ended else ""
    summary = kept if count >= 10 else f"{kept} {tail}"
    if count == 10:
        rest = ""
    assert sections(spark, plain, both) == [("", kept), (rest, summary)]


def random_document(draw):
    """(tag, id, text) of the children of one document."""
    children = []
    for _ in range(draw.randint(0, 26)):
        kind = draw.choice(["Heading", "P", "P", "P"])
        word = draw.choice(["SUMMARY", "BACKGROUND", "ABSTRACT", "BACKGROUND SUMMARY", "OTHER"])
        text = word if kind == "Heading" else words(draw.choice([1, 49, 50, 51, 100, 101, 140]), str(draw.random()))
        text = draw.choice([text, text, text, text, "", " " + text + " "])
        number = draw.choice([None, "", "x", *(f"{kind[0].lower()}-{n}" for n in range(8))])
        children.append((kind, number, text))
    return children


def number_of(node_id, undashed):
    return int(node_id.split("-")[1]) if "-" in node_id else undashed


def expected_sections(children, cap):
    """Read the children once; each section goes on where the one before ended."""
    last = {}
    for kind, node_id, text in children:
        if kind == "Heading":
            word = next((w for w in ("SUMMARY", "BACKGROUND") if w in text), None)
            last[word] = number_of(node_id, None) if node_id else None
    s, b = last.get("SUMMARY"), last.get("BACKGROUND")
    order = [("summary", s), ("background", b)]
    if s is None or (s and b and b < s):
        order.reverse()
    found = {"summary": "", "background": ""}
    if order[0][1] is None:
        return found["background"], found["summary"]
    rest = iter([(number_of(i, 0), text) for _, i, text in children if i])
    for name, number in order:
        if number is None:
            break
        kept, ended = [], False
        for child_number, text in rest:
            if child_number <= number or not text:
                continue
            if len(text) < 50 or len(kept) == cap:
                ended = True
                break
            kept.append(text)
        found[name] = " ".join(kept)
        if not ended:
            break
    return found["background"], found["summary"]


def expected_abstract(children):
    ids = [i for kind, i, text in children if kind == "Heading" and "ABSTRACT" in text]
    if ids and ids[0]:
        number = number_of(ids[0], 0)
        later = (t.strip() for _, i, t in children if i and number_of(i, 0) > number)
        found = next((t for t in later if len(t) > 100), None)
        if found:
            return found
    paragraphs = (t.strip() for kind, _, t in children if kind == "P")
    return next((t for t in paragraphs if len(t) > 50), None)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_documents(spark, seed):
    draw = random.Random(seed)
    drawn = [random_document(draw) for _ in range(1500)]
    xml = [document(*(element(*child) for child in children)) for children in drawn]
    rows = texts(spark, *xml)
    found = [((row.background, row.summary), row.abstract) for row in rows]
    wanted = [(expected_sections(c, V.PARAGRAPHS_PER_SECTION), expected_abstract(c)) for c in drawn]
    assert found == wanted
    assert sum(bool(b) for (b, _), _ in found) > 100 and sum(bool(s) for (_, s), _ in found) > 100


def test_random_documents_with_a_low_cap(spark):
    draw = random.Random(5)
    drawn = [random_document(draw) for _ in range(1500)]
    payloads = [
        (str(n), document(*(element(*child) for child in children)).encode())
        for n, children in enumerate(drawn)
    ]
    frame = spark.createDataFrame(payloads, "url string, content binary")
    nodes = document_nodes(payload_documents(frame))
    rows = with_spec_sections(indexed(nodes), at_most=3).collect()
    found = {int(row.url): (row.background, row.summary) for row in rows}
    assert found == {n: expected_sections(children, 3) for n, children in enumerate(drawn)}


def test_payload_pieces(spark):
    good = document(paragraph("p-1", words(60)))
    unended = V.XML_DECLARATION + START + paragraph("p-1", words(61))
    other = V.XML_DECLARATION + "<uspat:ClaimSet/>"
    late = V.XML_DECLARATION + " " * 70 + START + V.DOCUMENT_END
    broken = V.XML_DECLARATION + START + "<uscom:P>" + V.DOCUMENT_END
    declared = V.XML_DECLARATION + "<!DOCTYPE x>" + START + V.DOCUMENT_END
    mentions = document(paragraph("p-1", "&lt;!DOCTYPE is " + words(70), "<![CDATA[<!DOCTYPE x>]]>"))
    content = "text in front" + good + other + unended + late + broken + declared + mentions
    rows = [
        ("many", content.encode()),
        ("latin", document(paragraph("p-1", words(60, "é"))).encode("latin-1")),
        ("none", b"no declaration"),
        ("empty", b""),
        ("null", None),
    ]
    frame = spark.createDataFrame(rows, "url string, content binary")
    pieces = piece_texts(payload_documents(frame))
    many = {row.piece: row for row in pieces.filter("url = 'many'").collect()}
    assert sorted(many) == [0, 2, 4, 5, 6]
    assert (many[0].abstract, many[2].abstract) == (words(60), words(61))
    assert many[6].abstract.startswith("&lt;!DOCTYPE")
    bad = {(row.piece, row.stage): row.reason for row in quarantined(pieces).collect()}
    assert sorted(bad) == [(4, "xml"), (5, "xml")]
    assert bad[5, "xml"] == "document type declared" and "malformed" in bad[4, "xml"]
    assert many[4].summary is None and many[4].abstract is None
    others = pieces.filter("url <> 'many'").collect()
    assert [(row.url, row.abstract) for row in others] == [("latin", words(60, "é"))]


def test_node_rows_keep_document_order(spark):
    text = document(
        element("DocumentCode", None, "SPEC"),
        heading("h-1", "A", "<uscom:B>b</uscom:B>c<!-- note -->d"),
        element("Box", "x-1", "box", paragraph("p-7", "inner") + "tail"),
        "<other>plain</other>",
    )
    frame = spark.createDataFrame([("u", text.encode())], "url string, content binary")
    nodes = document_nodes(payload_documents(frame))
    rows = node_rows(nodes).orderBy("pos").collect()
    assert [(r.tag.split("}")[-1], r.root_child, r.node_id, r.text, r.tails) for r in rows] == [
        ("DocumentCode", True, None, "SPEC", []),
        ("Heading", True, "h-1", "A", ["cd"]),
        ("Box", True, "x-1", "box", ["tail"]),
        ("P", False, "p-7", "inner", []),
        ("other", True, None, "plain", []),
    ]
    assert rows[1].full_text == "Abcd"
    assert nodes.selectExpr(document_code()).first()[0] == "SPEC"


def test_extraction_plan_has_one_python_step_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "payloads")
    spark.createDataFrame([("u", b"")], "url string, content binary").write.parquet(path)
    frame = spark.read.parquet(path)
    plan = piece_texts(payload_documents(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan and "Window" not in plan


def test_parsing_holds_a_bounded_slice_of_a_batch():
    text = document(*(paragraph(f"p-{i}", words(1000)) for i in range(100)))
    large = document(paragraph("p-1", words(3 << 20)))
    batch = [text, None, "<broken", large, *[text] * 60, ""]
    found = list(_xml_parser()(iter([pa.array(batch), pa.array([], pa.string()), pa.array([text])])))
    assert [r for part in found for r in part.to_pylist()] == [
        r for one in [*batch, text] for part in _xml_parser()(iter([pa.array([one], pa.string())])) for r in part.to_pylist()
    ]
    assert [len(part) for part in found] == [3, 1, 10, 10, 10, 10, 10, 11, 0, 1] and 10 == SLICE_BYTES // len(text)


def test_nodes_in_long_form_are_parsed_once(spark):
    frame = spark.createDataFrame([("a", 0, document(paragraph("p-1", "x")))], "url string, piece int, xml string")
    plan = node_rows(document_nodes(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def python_steps(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"ArrowEvalPython \[parsed.*, (\d+)$", plan, re.M)


def test_texts_are_parsed_once_in_slices(spark):
    frame = spark.createDataFrame([("u", b"")], "url string, content binary")
    assert python_steps(piece_texts(payload_documents(frame))) == [str(PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)]


def test_document_codes_are_parsed_once_in_slices(spark, small):
    assert python_steps(xml_document_code(spark, small)) == [str(PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)]
