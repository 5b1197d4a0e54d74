"""HTML extraction: structure of the page, and runs repeated across pages of a host."""

import hashlib
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from foliosift.llm.common import likely_in, name_of, row_batches, row_of, with_columns
from foliosift.session import written

TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
STOP = re.compile("[>\"']")
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Elements whose content is no text, and those beside the main text.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select"}
ASIDE = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button", "figure"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
# Words of class, id and role that mark what is beside the main text.
BESIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
          "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer",
          "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
          "popup", "promo", "related", "share", "sharing", "sidebar", "social", "sponsor",
          "sponsored", "subscribe", "toolbar", "widget"}
# Words that only tell the place or shape of what the word before them names, as in share-bar.
SHAPE = {"area", "bar", "block", "box", "bottom", "button", "buttons", "container", "form", "icons",
         "left", "link", "links", "list", "menu", "panel", "popup", "right", "section", "top", "unit",
         "wrap", "wrapper"}
# Words that name it also behind words that say whose it is, as in site-footer.
ENDS = {"ads", "advert", "adverts", "breadcrumbs", "comments", "footer", "header", "menu", "nav", "navbar",
        "navigation", "newsletter", "sidebar"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MIN_TOKENS = 6
# A repeated run of so many tokens goes wherever it stands; a shorter one only as a whole block.
LONG_RUN = 30
# A block of main regions goes if so many pages have it, and half of all pages of the host.
MOST_PAGES = 10
SPACE = re.compile(r"\s+")


def names_beside(word):
    """Whether a class, id or role word names something beside the main text.

    A compound does so if its first part does and the others only say of what shape it is,
    ``share-bar`` but not ``share-price``, or if it ends in a name of such a part of a page.
    """
    first, *rest = re.split("[-_]", word)
    shaped = first in BESIDE and all(r in BESIDE or r in SHAPE for r in rest)
    return word in BESIDE or shaped or (rest and rest[-1] in ENDS)


def marked(attributes, inside):
    """Whether class, id or role names something beside the main text.

    Inside the main text a header is that of the text.
    """
    if "=" not in attributes:
        return False
    words = (w for m in NAMES.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").lower().split())
    return any(names_beside(w) and not (inside and w.endswith("header")) for w in words)


def tag_end(page, at, last):
    """Where the tag that is open at ``at`` ends; ``last`` has the last place of each quote.

    Quoted values may hold any character. A quote that is never closed is none. Each character
    is looked at once.
    """
    while stop := STOP.search(page, at):
        mark = stop.group()
        if mark == ">":
            return stop.end()
        at = page.index(mark, stop.end()) + 1 if last[mark] >= stop.end() else stop.end()
    return None


def blocks(page):
    """(text, state) of each block in page order.

    States: ``main`` inside article or main, ``beside`` inside an element that structure
    marks as no main text, ``plain`` elsewhere. Headers inside an article that hold its
    heading count as main. Unclosed paragraphs end where their container ends.
    """
    out, text, stack, opened = [], [], [], Counter()
    beside = main = 0

    def flush():
        words = SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if words:
            out.append((words, "beside" if beside else "main" if main else "plain"))

    def close():
        nonlocal beside, main
        name, was_beside, was_main = stack.pop()
        opened[name] -= 1
        beside, main = beside - was_beside, main - was_main
        return name

    at, size = 0, len(page)
    last = {mark: page.rfind(mark) for mark in "\"'"}
    while found := TAG.search(page, at):
        comment, other, ending, name = found.groups()
        if comment:
            end = page.find("-->", found.end())
            end = size if end < 0 else end + 3
        elif other:
            end = page.find(">", found.end()) + 1 or None
        else:
            end = tag_end(page, found.end(), last)
        if end is None:  # no tag ends any more: the rest is text
            break
        text.append(page[at : found.start()])
        at, attributes = end, page[found.end() : end - 1] if name else ""
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        if ending:
            while opened[name] and close() != name:
                pass
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "p" or (name == "li" and stack and stack[-1][0] == "li"):
            while stack and stack[-1][0] in {"p", "b", "i", "em", "strong", "span", "a", name}:
                if name == "li" and stack[-1][0] != "li":
                    break
                close()
        is_main = int(name in MAIN or ("role" in attributes and re.search(r"role\s*=\s*.?main\b", attributes) is not None))
        head = name == "header" and main > 0
        is_beside = int(
            (name in ASIDE and not head and name != "figure")
            or (name not in HEADINGS and marked(attributes, main > 0))
        )
        if name in INLINE and is_beside:
            flush()
        stack.append((name, is_beside, is_main))
        opened[name] += 1
        beside, main = beside + is_beside, main + is_main
    text.append(page[at:])
    flush()
    return out


def fingerprint(words):
    return int.from_bytes(
        hashlib.blake2b(" ".join(words).encode(), digest_size=8).digest(), "little", signed=True
    )


def suffix_heads(tokens, least):
    """(place, fingerprint of the first ``least`` tokens, that of the first ``LONG_RUN``) of each
    suffix long enough; the second is 0 where fewer tokens follow."""
    return [
        (i, fingerprint(tokens[i : i + least]),
         fingerprint(tokens[i : i + LONG_RUN]) if i + LONG_RUN <= len(tokens) else 0)
        for i in range(len(tokens) - least + 1)
    ]


def block_heads(parts, least):
    """(number of the block, fingerprint, 0) of each long enough block of the main region.

    Only whole blocks may go there, so suffixes begin at blocks and count up to their ends.
    """
    tokens = ((i, words.split(" ")) for i, (words, state) in enumerate(parts) if state == "main")
    return [(i, fingerprint(["", *own]), 0) for i, own in tokens if len(own) >= least]


def open_tokens(parts):
    """Tokens of the blocks outside the main text; where blocks begin among them."""
    tokens, starts = [], []
    for words, state in parts:
        if state != "main":
            starts.append(len(tokens))
            tokens += words.split(" ")
    return tokens, starts


def declared_text(parts, boilerplate=()):
    """The main region of a page, null where the page declares none.

    ``boilerplate`` holds the numbers of blocks that most pages of the host repeat. They go
    from a region that is mostly the page's own; one that is not is a copy, and stays.
    """
    main = [(i, words) for i, (words, state) in enumerate(parts) if state == "main"]
    if not main:
        return None
    own = [words for i, words in main if i not in boilerplate]
    if 2 * sum(w.count(" ") + 1 for w in own) <= sum(w.count(" ") + 1 for _, w in main):
        own = [words for _, words in main]
    return "\n".join(own)


def unique_text(parts, repeated, long, least):
    """A page without main region: its plain blocks without the repeated runs.

    ``repeated`` holds the places of suffixes whose first ``least`` tokens are repeated, ``long``
    of those whose first ``LONG_RUN`` tokens are.
    """
    tokens, starts = open_tokens(parts)
    covered = bytearray(len(tokens))
    for place in repeated:
        covered[place : place + least] = b"\1" * least
    for place in long:
        covered[place : place + LONG_RUN] = b"\2" * LONG_RUN
    kept = []
    for (words, state), start in zip(parts, starts, strict=True):
        own = words.split(" ")
        marks = covered[start : start + len(own)]
        if state != "plain" or all(marks):
            continue
        kept.append(" ".join(w for w, mark in zip(own, marks, strict=True) if mark < 2))
    return "\n".join(filter(None, kept))


def extract_text(pages, key="page_id", url="url", page="html", min_tokens=MIN_TOKENS, text="text"):
    """``pages`` with the main text of each page in the column ``text``, without ``page``.

    The token streams of all pages of a host are searched for what distinct pages share. For
    that, all their suffixes are brought into one order by host and first tokens, dealt by
    range, so the pages of a very large host spread over all tasks. Neighbours tell the common
    lengths: those of ``min_tokens`` and of ``LONG_RUN`` tokens decide, so the order goes so far
    and by fingerprints of so many tokens. Main regions put in the suffixes that begin at their
    blocks, as only whole blocks go there; the rest of a page all suffixes.

    Structure decides first: menus, headers, footers, sidebars, notices, adverts, forms,
    comments, scripts and styles never stay, repeated or not. A page with article or main keeps
    what is in there, also passages that articles share, but not blocks of ``min_tokens`` tokens
    that stand in the main regions of ``MOST_PAGES`` distinct pages and of half of those of the
    host. On other pages blocks that repeated runs cover go, and runs of ``LONG_RUN`` tokens that
    another page has as one run wherever they stand. A shorter run inside a sentence stays.
    Class names count as whole words only.

    Tags without end and end tags without start cost no more than others: a page is read once.

    A null or empty page gives an empty text. Pages without a host form one host; rows of
    one page id are one page; a row without id is never counted as distinct. All columns
    stay but ``page``; one named like ``text`` is replaced. An empty table gives an empty
    result.
    """
    host = F.lower(F.regexp_extract(F.coalesce(name_of(url), F.lit("")), r"^\w+://([^/?#]*)", 1))
    content = F.coalesce(name_of(page), F.lit(""))
    rows = pages.select(
        F.xxhash64(name_of(key)).alias("id"),
        F.xxhash64(content).alias("sign"),
        content.alias("page"),
        row_of(pages, page),
    )
    streams = pages.filter(name_of(key).isNotNull()).select(
        F.xxhash64(name_of(key)).alias("id"),
        F.xxhash64(host).alias("host"),
        F.xxhash64(content).alias("sign"),
        content.alias("page"),
    )
    suffixes = streams.mapInArrow(
        suffix_rows(min_tokens), "id long, host long, sign long, kind int, place int, head long, deep long"
    )
    suffixes = written(suffixes, "suffixes")
    hosts = streams.groupBy("host").agg(F.count_distinct("sign").alias("of"))
    found = written(repeated_places(suffixes, hosts), "places")
    on = ["id", "sign"]
    none = {name: F.lit(None).cast("array<int>") for name in ("short", "long", "blocks")}
    likely = likely_in(rows, found, on).join(found, on, "left")
    parsed = likely.unionByName(likely_in(rows, found, on, others=True).withColumns(none))
    row_type = rows.schema["row"].dataType.simpleString()
    texts = parsed.select("row", "page", *none).mapInArrow(
        read_texts(min_tokens), f"row {row_type}, text string"
    )
    columns = [c for c in pages.columns if c != page]
    return with_columns(texts, {text: F.col("text")}, columns)


OPEN, EVIDENCE, BLOCK = 0, 1, 2  # Suffixes of pages without main region; beside one; its blocks.


def suffix_rows(least):
    """Suffixes of each page that the order of the host needs, with their ``kind``."""

    def heads(batches):
        for batch in row_batches(batches):
            found = []
            for i, page in enumerate(batch.column("page").to_pylist()):
                parts = blocks(page)
                main = block_heads(parts, least)
                kind = OPEN if declared_text(parts) is None else EVIDENCE
                found += ((i, kind, *suffix) for suffix in suffix_heads(open_tokens(parts)[0], least))
                found += ((i, BLOCK, *suffix) for suffix in main)
            rows = pa.array([f[0] for f in found], pa.int64())
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in ("id", "host", "sign")),
                    *(pa.array([f[n] for f in found], t) for n, t in enumerate(types, 1)),
                ],
                ["id", "host", "sign", "kind", "place", "head", "deep"],
            )

    return heads


PREFIX, OWNER = ["host", "head", "deep"], ["sign", "id"]


def neighbours(batches):
    """For each prefix that neighbours in the order share, how often page and id change.

    A prefix is (host, head, deep), or with 0 for deep that of ``least`` tokens alone. The first
    and the last row of the partition follow with its number, as its neighbours are elsewhere.
    """
    part, first, last = TaskContext.get().partitionId(), None, None
    names = [*PREFIX, *OWNER]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy() for c in names])
        first = rows[:, :1] if first is None else first
        rows = rows if last is None else np.hstack([last, rows])
        last = rows[:, -1:]
        host, head, deep, sign, owner = rows
        near = (host[1:] == host[:-1]) & (head[1:] == head[:-1])
        far = near & (deep[1:] == deep[:-1]) & (deep[1:] != 0)
        changes = np.stack([sign[1:] != sign[:-1], owner[1:] != owner[:-1]])
        for same, level in ((near, 0), (far, 1)):
            at = np.flatnonzero(same & changes.any(axis=0)) + 1
            if not len(at):
                continue
            prefix = rows[:3, at] if level else np.vstack([rows[:2, at], np.zeros((1, len(at)), np.int64)])
            begins = np.flatnonzero(np.append(True, (prefix[:, 1:] != prefix[:, :-1]).any(axis=0)))
            sums = np.add.reduceat(changes[:, at - 1].astype(np.int64), begins, axis=1)
            yield neighbour_batch(-1, prefix[:, begins], sums)
    if first is not None:
        for end, row in enumerate((first, last)):
            yield neighbour_batch(2 * part + end, row[:3], row[3:])


def neighbour_batch(part, prefix, owners):
    columns = [pa.array(np.full(prefix.shape[1], part), pa.int64()), *map(pa.array, (*prefix, *owners))]
    return pa.RecordBatch.from_arrays(columns, ["part", *PREFIX, *OWNER])


def shared_prefixes(suffixes):
    """(host, head, deep, pages): prefixes of suffixes on distinct pages, as neighbours tell.

    Distinct pages: of several ids and several contents, as copies of a page repeat it all.
    ``pages`` is the number of contents for suffixes without ``deep``, which come in their order;
    for others it is only known to be 2 or more.
    """
    order = [*PREFIX, *OWNER]
    ordered = suffixes.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part long, host long, head long, deep long, sign long, id long"
    met = written(ordered.mapInArrow(neighbours, schema), "neighbours")
    # Two rows a partition: the last one of each meets the first one of the next.
    ends = Window.orderBy("part")
    before = {f"_{c}": F.lag(c).over(ends) for c in order}
    edges = met.filter("part >= 0").withColumns(before).filter("part % 2 = 0 and host = _host and head = _head")
    changes = [F.expr(f"cast({c} <> _{c} as long)").alias(c) for c in OWNER]
    near = edges.select("host", "head", F.lit(0).cast("long").alias("deep"), *changes)
    far = edges.filter("deep = _deep and deep <> 0").select(*PREFIX, *changes)
    counts = met.filter("part < 0").select(*order).unionByName(near).unionByName(far)
    sums = counts.groupBy(*PREFIX).agg(F.sum("sign").alias("signs"), F.sum("id").alias("ids"))
    return sums.filter("signs > 0 and ids > 0").select(*PREFIX, (F.col("signs") + 1).alias("pages"))


def repeated_places(suffixes, hosts):
    """(id, sign, short, long, blocks): repeated places of each page that has any."""
    shared = written(shared_prefixes(suffixes), "shared")
    most = shared.filter(f"deep = 0 and pages >= {MOST_PAGES}").join(hosts, "host").filter("2 * pages >= of")
    free, main = suffixes.filter(f"kind = {OPEN}"), suffixes.filter(f"kind = {BLOCK}")
    places = {
        "short": free.join(shared.filter("deep = 0"), ["host", "head"], "left_semi"),
        "long": free.join(shared.filter("deep <> 0"), PREFIX, "left_semi"),
        "blocks": main.join(most, ["host", "head"], "left_semi"),
    }
    parts = [df.select("id", "sign", F.lit(name).alias("name"), "place") for name, df in places.items()]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sets = [F.collect_set(F.when(F.col("name") == name, F.col("place"))).alias(name) for name in places]
    return rows.groupBy("id", "sign").agg(*sets)


def read_texts(least):
    """Main text of pages, of which the repeated places are known."""

    def read(batches):
        for batch in row_batches(batches):
            columns = (batch.column(c).to_pylist() for c in ("page", "short", "long", "blocks"))
            found = []
            for page, short, long, repeated in zip(*columns, strict=True):
                parts = blocks(page)
                text = declared_text(parts, set(repeated or ()))
                found.append(unique_text(parts, short or (), long or (), least) if text is None else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.string())], ["row", "text"]
            )

    return read


def op10_html_text(spark, sf_dir):
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract_text(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
