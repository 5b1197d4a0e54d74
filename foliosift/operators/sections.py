"""Abstract, summary and background of one document. Map-only on node lists."""

from foliosift import fixed_values as V
from foliosift.functions.ids import id_is_broken, id_number
from foliosift.functions.nodes import (
    children,
    direct_text,
    first_heading_id,
    first_long_paragraph,
    headings,
    last_heading_id,
    longer_when_stripped,
)
from foliosift.functions.text import literal, stripped

BROKEN_ID = "id without a number after the dash"


def _with(df, columns):
    """Add columns in one select; each may use those before it."""
    return df.selectExpr("*", *(f"{text} as {name}" for name, text in columns.items()))


def indexed(documents, nodes="nodes"):
    """Add ``headings`` and ``children``, which the section rules below look at."""
    return _with(documents, {"headings": headings(nodes), "children": children(nodes)})


def with_abstract(
    documents,
    nodes="nodes",
    word="ABSTRACT",
    longer_than=V.ABSTRACT_LENGTH,
    fallback_longer_than=V.FALLBACK_LENGTH,
):
    """Add ``abstract`` and ``abstract_error`` to indexed documents.

    The abstract is the first numbered child behind the first heading with ``word``
    whose stripped text is longer than ``longer_than``; without one, the first
    paragraph longer than ``fallback_longer_than``. A broken id met before that child
    leaves the document without an abstract.
    """
    behind = "filter(children, c -> c.num is null or c.num > _number)"
    texts = (
        f"transform({behind}, c -> named_struct('broken', c.num is null, "
        f"'text', {direct_text('c.text', 'c.tails', ' ')}))"
    )
    hits = f"filter({texts}, c -> c.broken or {longer_when_stripped('c.text', longer_than)})"
    found = f"coalesce(_hit.text, {first_long_paragraph(fallback_longer_than, nodes)})"
    columns = {
        "_heading_id": first_heading_id(word),
        "_number": id_number("_heading_id"),
        "_hit": f"if(_number is not null, try_element_at({hits}, 1), null)",
        "_broken": f"{id_is_broken('_heading_id')} or coalesce(_hit.broken, false)",
        "_found": f"if(_broken, null, {found})",
        "abstract_error": f"if(_broken, {literal(BROKEN_ID)}, null)",
        "abstract": stripped("_found"),
    }
    own = [name for name in columns if name.startswith("_")]
    return _with(documents, columns).drop(*own)


def with_spec_sections(
    documents,
    summary_word="SUMMARY",
    background_word="BACKGROUND",
    shorter_than=V.HEADING_LENGTH,
    at_most=V.PARAGRAPHS_PER_SECTION,
):
    """Add ``summary``, ``background`` and ``spec_error`` to indexed documents.

    A section holds the numbered children behind its heading until a short one or one
    beyond ``at_most`` ends it. The second section may start only behind the end of
    the first; the summary comes first unless the background heading has the lower,
    non-zero number. Any broken id leaves both sections null.
    """

    def candidates(number, after=""):
        # One more than a section may hold is enough to see where it ends.
        behind = f"filter(children, c -> c.num > {number} and c.text <> ''{after})"
        return f"slice({behind}, 1, {at_most + 1})"

    def end(found):
        # Index of the candidate that ends the section; null where none does.
        short = f"array_position(transform({found}, c -> length(c.text) < {shorter_than}), true)"
        full = f"if(size({found}) > {at_most}, {at_most + 1}, null)"
        return f"cast(coalesce(nullif({short}, 0), {full}) as int)"

    def joined(found, stop):
        kept = f"slice({found}, 1, coalesce({stop} - 1, size({found})))"
        return f"coalesce(array_join(transform({kept}, c -> c.text), ' '), '')"

    columns = {
        "_s_id": last_heading_id(summary_word),
        "_b_id": last_heading_id(background_word, summary_word),
        "_broken": f"{id_is_broken('_s_id')} or {id_is_broken('_b_id')} "
        "or exists(children, c -> c.num is null)",
        "_s": id_number("_s_id", undashed="null"),
        "_b": id_number("_b_id", undashed="null"),
        "_background_leads": "coalesce(_s <> 0 and _b <> 0 and _b < _s, false)",
        "_summary_leads": "_s is not null and not _background_leads",
        "_n1": "if(_summary_leads, _s, _b)",
        "_n2": "case when _summary_leads then _b when _background_leads then _s end",
        "_c1": candidates("_n1"),
        "_e1": end("_c1"),
        "_t1": joined("_c1", "_e1"),
        "_stop": "try_element_at(_c1, _e1).pos",
        "_c2": candidates("_n2", " and c.pos > _stop"),
        "_e2": end("_c2"),
        "_t2": joined("_c2", "_e2"),
    }
    # Null for a document that is broken or was not parsed.
    return _with(documents, columns).selectExpr(
        *documents.columns,
        "case when not _broken then if(_summary_leads, _t1, _t2) end as summary",
        "case when not _broken then if(_summary_leads, _t2, _t1) end as background",
        f"if(_broken, {literal(BROKEN_ID)}, null) as spec_error",
    )
