"""The catalogue queries as SQL for a second engine, on the same tables."""

from foliosift.catalogue import queries as Q
from foliosift.catalogue import views
from foliosift.functions.text import WHITE_SPACE

WITH_APPS = """
with codes as (
    select l_orderkey,
           list_sort(list(distinct p_brand)) as code_list,
           min(p_name) as title
    from lineitem join part on p_partkey = l_partkey
    group by l_orderkey
), apps as (
    select cast(o_orderkey as varchar) as application_number,
           cast(cast(o_orderdate as date) as varchar) as filing_date,
           code_list,
           array_to_string(code_list, ',') as cpcs,
           title as invention_title,
           o_orderstatus as status_code,
           nullif(o_orderpriority, '4-NOT SPECIFIED') as status_desc
    from orders left join codes on l_orderkey = o_orderkey
)
"""
APP_COLUMNS = "application_number, filing_date, cpcs, invention_title, status_code, status_desc"

# The application number cut short, or none, as several applications may share one.
_SHARED_NUMBER = APP_COLUMNS.replace(
    "application_number",
    "case when status_code <> 'F' then right(application_number, 2) end as application_number",
)

WITH_LINES = """
with lines as (
    select doc_id, lang, source,
           unnest(range(len(parts))) as pos,
           unnest(parts) as line
    from (select doc_id, lang, source, string_split(text, chr(10)) as parts from documents)
)
"""

_STRIP = "trim({}, " + " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"

# Abstract, background and summary of every document, from its lines.
DOCUMENT_TEXTS = (
    WITH_LINES
    + f"""
, headings as (
    select doc_id,
           min(pos) filter (length(line) < 50 and contains(upper(line), 'TH')) as h,
           max(pos) filter (length(line) < 50 and contains(upper(line), 'TH')) as s,
           max(pos) filter (length(line) < 50 and contains(upper(line), 'AN')
                            and not contains(upper(line), 'TH')) as b
    from lines group by doc_id
), plan as (
    select doc_id, h, s, b, coalesce(s <> 0 and b <> 0 and b < s, false) as background_leads,
           s is not null and not coalesce(s <> 0 and b <> 0 and b < s, false) as summary_leads
    from headings
), bounds as (
    select *, case when summary_leads then s else b end as n1,
           case when summary_leads then b when background_leads then s end as n2
    from plan
), c1 as (
    select l.doc_id, pos, line, row_number() over (partition by l.doc_id order by pos) as rn
    from lines l join bounds using (doc_id) where pos > n1 and line <> ''
), e1 as (
    select doc_id, min(pos) as stop from c1 where length(line) < 50 or rn = 11 group by doc_id
), t1 as (
    select c1.doc_id, string_agg(line, ' ' order by pos) as txt
    from c1 left join e1 using (doc_id) where stop is null or pos < stop group by c1.doc_id
), c2 as (
    select l.doc_id, pos, line, row_number() over (partition by l.doc_id order by pos) as rn
    from lines l join bounds using (doc_id) join e1 using (doc_id)
    where pos > n2 and pos > stop and line <> ''
), e2 as (
    select doc_id, min(pos) as stop from c2 where length(line) < 50 or rn = 11 group by doc_id
), t2 as (
    select c2.doc_id, string_agg(line, ' ' order by pos) as txt
    from c2 left join e2 using (doc_id) where stop is null or pos < stop group by c2.doc_id
), hits as (
    select l.doc_id, min_by({_STRIP.format('line')}, pos) as txt
    from lines l join bounds using (doc_id)
    where pos > h and length({_STRIP.format('line')}) > 100 group by l.doc_id
), fallbacks as (
    select doc_id, min_by({_STRIP.format('line')}, pos) as txt
    from lines where length(line) >= 50 and length({_STRIP.format('line')}) > 50 group by doc_id
), texts as (
    select bounds.doc_id, coalesce(hits.txt, fallbacks.txt) as abstract,
           coalesce(case when summary_leads then t2.txt else t1.txt end, '') as background,
           coalesce(case when summary_leads then t1.txt else t2.txt end, '') as summary
    from bounds left join t1 using (doc_id) left join t2 using (doc_id)
         left join hits using (doc_id) left join fallbacks using (doc_id)
)
"""
)

# Files with texts to the best texts of each application; needs a table ``files``.
BEST_OF_FILES = """
, running as (
    select *,
        max(length(abstract)) over earlier as seen_abstract,
        max(length(background)) over earlier as seen_background,
        max(length(summary)) over earlier as seen_summary
    from files
    window earlier as (partition by application_number, doc_type order by seq
                       rows between unbounded preceding and 1 preceding)
), kept as (
    select * from running
    where not coalesce(doc_type = 'ABST' and seen_abstract >= 300, false)
      and not coalesce(doc_type = 'SPEC' and seen_background >= 300
                       and seen_summary >= 300, false)
), best as (
    select application_number,
        coalesce(first(abstract order by length(abstract) desc nulls last, seq)
                 filter (doc_type = 'ABST'), '') as abstract,
        coalesce(first(background order by length(background) desc nulls last, seq)
                 filter (doc_type = 'SPEC'), '') as background,
        coalesce(first(summary order by length(summary) desc nulls last, seq)
                 filter (doc_type = 'SPEC'), '') as summary
    from kept group by application_number
)
"""


def _no_prefix(prefixes, codes="code_list"):
    tests = " or ".join(f"starts_with(x, '{p}')" for p in prefixes)
    return f"not coalesce(len(list_filter({codes}, lambda x: {tests})) > 0, false)"


def _no_term(*terms):
    return " and ".join(
        f"not coalesce(contains(lower(invention_title), '{t}'), false)" for t in terms
    )


def _any_code(patterns):
    tests = " or ".join(
        f"starts_with(x, '{p[:-1]}')" if p.endswith("*") else f"x = '{p}'" for p in patterns
    )
    return f"len(list_filter(code_list, lambda x: {tests})) > 0"


_STATUS_LIST = ", ".join(f"'{s}'" for s in Q.STATUSES)
_NO_STATUS = f"not coalesce(status_desc in ({_STATUS_LIST}), false)"
_LOWER_TITLE = (
    "application_number, filing_date, cpcs, lower(invention_title) as invention_title, "
    "status_code, status_desc"
)
_IN_RANGE = f"filing_date between '{Q.FIRST}' and '{Q.LAST}'"

_SELECTED = (
    f"{WITH_APPS} select {_LOWER_TITLE} from apps where {_no_prefix(Q.PREFIXES)} "
    f"and {_no_term(*Q.TERMS, *Q.MORE_TERMS)} and {_NO_STATUS}"
)

_WITH_MATCHES = (
    WITH_APPS
    + """
, brands as (
    select p_brand, count(*) filter (p_type = 'ECONOMY') as economy,
           count(*) filter (p_type = 'PROMO') as promo,
           count(*) filter (p_type = 'LARGE') as large
    from part group by p_brand
), patterns as (
    select p_brand as txt, economy > large as wild from brands where economy > promo
), matches as (
    select distinct application_number
    from (select application_number, unnest(code_list) as code from apps)
         join patterns on code = txt or (wild and starts_with(code, txt))
)
"""
)

_NUMBERED = (
    WITH_APPS
    + """
, numbered as (
    select *, row_number() over (order by application_number) - 1 as position from apps
), paged as (
    select *, position // 50 as page from numbered
)
"""
)

_PIECES = """
with parts as (
    select page_id, string_split(html, '<p>') as list from pages
), pieces as (
    select page_id, unnest(range(len(list) - 1)) as piece, unnest(list[2:]) as part from parts
), restored as (
    select page_id, piece, '<p>' || string_split(part, '</p>')[1] || '</p>' as part from pieces
)
"""

_OPTIONS = (
    WITH_LINES
    + """
, typed as (
    select doc_id, pos, line,
           case when length(line) < 50 then 'ABST' when contains(line, '?') then 'CLM'
                else 'SPEC' end as doc_type
    from lines
), ranked as (
    select *, row_number() over (partition by doc_id, doc_type order by pos) - 1 as rn
    from typed where doc_type in ('SPEC', 'ABST')
), options as (
    select cast(doc_id as varchar) as application_number, doc_type,
           case doc_type when 'ABST' then 2147483648 else 0 end + 2 * rn as seq,
           line as url,
           case when contains(line, ',') then 'XML' else 'PDF' end as mime
    from ranked
    union all
    select cast(doc_id as varchar), doc_type,
           case doc_type when 'ABST' then 2147483648 else 0 end + 2 * rn + 1,
           lower(line), 'XML'
    from ranked
)
"""
)

# Applications of a few documents each, and their listed documents in order.
_LISTED = (
    DOCUMENT_TEXTS
    + f""", listed as (
    select doc_id, doc_id // {views.DOCUMENTS_EACH} as number,
           case when lang = 'en' then 'SPEC' else 'ABST' end as doc_type,
           doc_id % 7 <> 3 as landed, doc_id % 11 = 5 as malformed, doc_id % 13 = 6 as declares
    from documents where doc_id // {views.DOCUMENTS_EACH} % 5 <> 2
)
"""
)
_ENRICHED = f"""{_LISTED}, files as (
    select cast(number as varchar) as application_number,
           doc_id + case doc_type when 'ABST' then 2147483648 else 0 end as seq, doc_type,
           case when not malformed and not declares then abstract end as abstract,
           case when not malformed and not declares then background end as background,
           case when not malformed and not declares then summary end as summary
    from listed join texts using (doc_id) where landed
)
{BEST_OF_FILES}, waiting as (
    select cast(number as varchar) as application_number, count(*) as n from listed
    where not landed group by number
)
select a.application_number, a.lang, best.abstract, best.summary, best.background,
       coalesce(waiting.n, 0) as payloads_missing
from (select cast(doc_id // {views.DOCUMENTS_EACH} as varchar) as application_number, min(lang) as lang
      from documents group by all) a
left join best using (application_number) left join waiting using (application_number)
"""

_TURNS = """
with files as (
    select conv_id as application_number, turn as seq, role as doc_type, text from conversations
)
"""

ORACLES = {
    "select_applications": _SELECTED,
    "incremental_available_now": _SELECTED,
    "cpc_exclude_prefix": f"{WITH_APPS} select {APP_COLUMNS} from apps where {_no_prefix(Q.PREFIXES)}",
    "title_term_exclude": (
        f"{WITH_APPS} select {_LOWER_TITLE} from apps where {_no_term(*Q.TERMS, *Q.MORE_TERMS)}"
    ),
    "status_exclude": f"{WITH_APPS} select {APP_COLUMNS} from apps where {_NO_STATUS}",
    "cpc_include_exact": (
        f"{WITH_APPS} select {APP_COLUMNS} from apps where {_any_code(Q.EXACT_CODES)}"
    ),
    "cpc_include_prefix": (
        f"{WITH_APPS} select {APP_COLUMNS} from apps where {_any_code(Q.WILDCARDS)}"
    ),
    "cpc_include_table": f"{_WITH_MATCHES} select application_number from matches",
    "cpc_exclude_table": (
        f"{_WITH_MATCHES} select {APP_COLUMNS} from apps "
        "where application_number not in (select application_number from matches)"
    ),
    "cpc_include_join": (
        f"{_WITH_MATCHES} select {_SHARED_NUMBER} from apps "
        "where application_number in (select application_number from matches)"
    ),
    "cpc_exclude_join": (
        f"{_WITH_MATCHES} select {_SHARED_NUMBER} from apps "
        "where application_number not in (select application_number from matches)"
    ),
    "search_all_pages": (
        f"{WITH_APPS} select {APP_COLUMNS} from apps where {_IN_RANGE} and {_any_code(Q.WILDCARDS)}"
    ),
    "filing_range_page": (
        f"{WITH_APPS} select {APP_COLUMNS} from apps where {_IN_RANGE} "
        "order by filing_date desc, application_number limit 100 offset 300"
    ),
    "facet_counts": f"""{WITH_APPS}
        select 'application_type' as facet, status_desc as value, count(*) as n
        from apps group by status_desc
        union all
        select 'status_code', status_code, count(*) from apps group by status_code""",
    "code_list_round_trip": f"{WITH_APPS} select application_number, cpcs from apps",
    "nested_flatten": """
        select event_id, event_type,
               coalesce(cast(json_extract(props, '$.k') as bigint), user_id) as k,
               json_extract_string(props, '$.missing') as missing
        from events""",
    "search_response_rows": f"""{WITH_APPS}
        select {APP_COLUMNS}, cast(null as varchar) as patent_number,
               cast(null as varchar) as grant_date from apps""",
    "application_csv_rows": f"""{WITH_APPS}
        select application_number, filing_date, cpcs, 'a "b", ' || invention_title as invention_title,
               status_code, status_desc from apps""",
    "stored_application_rows": f"""{WITH_APPS}
        select status_code, count(*) * case when status_code = 'F' then 2 else 1 end as n,
               max(application_number) as last
        from apps group by status_code""",
    "mixed_header_csv": f"""{WITH_APPS}
        select application_number, filing_date, cpcs, '  a "b",' || chr(10) || invention_title || ' ' as invention_title,
               status_code, if(status_code = 'F', status_desc, null) as status_desc
        from apps""",
    "page_slices": f"""{_NUMBERED}
        select page // 100 as bucket, page, count(*) as n_rows,
               max(application_number) as last_application_number
        from paged group by page""",
    "deep_page": f"""{WITH_APPS}, ranked as (
            select *, row_number() over
                (order by filing_date desc, status_code, application_number) - 1 as position
            from apps
        )
        select filing_date, status_code, application_number from ranked,
            (select count(*) // 2 // 100 as middle from apps)
        where position // 100 in (middle, middle + 1)""",
    "page_slice": """
        with ranked as (
            select o_orderkey as application_number, o_orderstatus, row_number() over
                (order by o_orderkey % 2, o_orderkey) - 1 as position, count(*) over () as n
            from orders
        )
        select application_number, o_orderstatus, position, position // 50 as page,
               position // 500 as bucket
        from ranked where position // 50 in (n // 100 - 1, n // 100)""",
    "stored_order_pages": """
        with numbered as (select (row_number() over () - 1) // 50 as page from orders)
        select page // 10 as bucket, count(*) as n_rows, count(distinct page) as n_pages
        from numbered group by page // 10""",
    "bucketed_output": f"""{_NUMBERED}
        select page // 100 as bucket, count(*) as n_rows,
               min(application_number) as first_number, max(application_number) as last_number
        from paged group by page // 100""",
    "payload_split": f"{_PIECES} select page_id, piece, part from restored",
    "payload_marker": (
        f"{_PIECES} select page_id, piece from restored where contains(left(part, 100), 'the')"
    ),
    "decode_bytes": "select doc_id, text as from_utf8, text as from_latin1 from documents",
    "id_numbers": f"""{WITH_LINES}, kinds as (
            select doc_id, pos,
                   case when length(line) = 0 then 'none' when contains(line, '?') then 'broken'
                        when contains(line, ',') then 'undashed' else 'number' end as kind
            from lines)
        select doc_id, pos, case kind when 'none' then 0 else 1 end as has_id,
               case kind when 'undashed' then '0' when 'number' then cast(pos as varchar) end
                   as paragraph_number,
               case kind when 'number' then cast(pos as varchar) end as heading_number,
               case kind when 'broken' then 1 else 0 end as broken
        from kinds""",
    "first_heading": f"""{DOCUMENT_TEXTS} select doc_id, 'n-' || h as first_id from headings""",
    "last_heading": f"""{DOCUMENT_TEXTS}
        select doc_id, 'n-' || s as summary_id, 'n-' || b as background_id from headings""",
    "abstract_text": f"{DOCUMENT_TEXTS} select doc_id, abstract from texts",
    "section_text": f"{DOCUMENT_TEXTS} select doc_id, background, summary from texts",
    "listed_options": f"{_OPTIONS} select application_number, doc_type, seq, url, mime from options",
    "typed_parts": f"""{_OPTIONS}
        select application_number, url, min(seq) as seq, max_by(doc_type, seq) as doc_type
        from options where mime = 'XML' group by application_number, url""",
    "longest_part": f"""{_TURNS}
        select application_number, doc_type,
               first(text order by length(text) desc, seq) as text
        from files group by application_number, doc_type""",
    "early_stop_longest": f"""{_TURNS}, running as (
            select *, max(length(text)) over (partition by application_number, doc_type order by seq
                          rows between unbounded preceding and 1 preceding) as seen
            from files)
        select application_number, doc_type,
               first(text order by length(text) desc, seq) as text
        from running where coalesce(seen, 0) < 300 group by application_number, doc_type""",
    "early_stop_two_texts": f"""
        with files as (
            select conv_id as application_number, turn as seq, 'SPEC' as doc_type,
                   left(text, length(text) // 2) as background,
                   substring(text, length(text) // 2 + 1) as summary,
                   cast(null as varchar) as abstract
            from conversations)
        {BEST_OF_FILES}
        select application_number, background, summary from best""",
    "landed_records_quarantine": f"""{WITH_APPS}, kinds as (
            select *, cast(application_number as bigint) % 5 as kind from apps)
        select application_number, filing_date, invention_title, cast(null as varchar) as reason
        from kinds where kind in (1, 2, 4)
        union all
        select 'x' || application_number, filing_date, invention_title, null
        from kinds where kind = 1
        union all
        select application_number, null, null,
               case kind when 0 then 'malformed JSON' else 'no patentFileWrapperDataBag' end
        from kinds where kind in (0, 3)""",
    "search_from_responses": f"""{WITH_APPS}, landed as (
            select * replace (if(again, 'x', '') || application_number as application_number)
            from apps, (values (false), (true)) twice(again)
            where cast(application_number as bigint) % 5 in (1, 2, 4)
              and (not again or cast(application_number as bigint) % 5 = 1))
        select {APP_COLUMNS} from landed where {_IN_RANGE} and {_any_code(Q.WILDCARDS)}""",
    "payload_files": f"""{DOCUMENT_TEXTS}
        select doc_id // 64 as part, count(*) as n_documents,
               cast(sum(length(abstract)) as bigint) as abstracts,
               cast(sum(length(background)) as bigint) as backgrounds,
               cast(sum(length(summary)) as bigint) as summaries
        from texts group by doc_id // 64""",
    "enrich_from_listings": _ENRICHED,
    "late_payloads": _ENRICHED,
    "quarantined_documents": f"""{_LISTED}
        select cast(doc_id as varchar) as url, if(landed, 0, null) as piece,
               if(landed, 'xml', 'payload') as stage,
               case when not landed then 'payload missing' when declares then 'document type declared'
                    else 'malformed XML' end as reason
        from listed where not landed or declares or malformed""",
    "enrich_left": f"""{DOCUMENT_TEXTS}, files as (
            select cast(l.doc_id as varchar) as application_number, 0 as seq,
                   case when quality = 1 then 'SPEC' else 'ABST' end as doc_type,
                   abstract, background, summary
            from labels l left join texts using (doc_id))
        {BEST_OF_FILES}
        select cast(doc_id as varchar) as application_number, lang,
               best.abstract, best.summary, best.background
        from documents left join best on application_number = cast(doc_id as varchar)""",
    "pending_applications": """
        select doc_id, lang from documents
        where not exists (select 1 from labels where labels.doc_id = documents.doc_id)""",
    "xml_nodes": f"""{WITH_LINES}
        select doc_id, case when length(line) < 50 then 'Heading' else 'P' end as tag,
               'n-' || pos as node_id, nullif(line, '') as text,
               {_STRIP.format('line')} as direct_text,
               case when length(line) < 50 then replace(upper({_STRIP.format('''line ||
                   case when contains(upper(line), 'TH') then 'abstract and summary'
                        when contains(upper(line), 'AN') then 'background'
                        else 'note' end''')}), chr(7838), 'SS') end as heading_text
        from lines""",
    "xml_document_code": "select doc_id, lang as code from documents",
    "xml_sections": f"""{DOCUMENT_TEXTS}
        select doc_id, abstract, background, summary, cast(null as varchar) as xml_error
        from texts""",
    "best_documents": f"""{DOCUMENT_TEXTS}, files as (
            select source as application_number, doc_id as seq,
                   case when lang = 'en' then 'SPEC' else 'ABST' end as doc_type,
                   abstract, background, summary
            from documents join texts using (doc_id))
        {BEST_OF_FILES}
        select application_number, lang, abstract, summary, background
        from (select distinct source as application_number, lang from documents)
             left join best using (application_number)""",
}
