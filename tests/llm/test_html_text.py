import html
import re
import time

from cases import given
from foliosift.llm.html_text import blocks, extract_text, op10_html_text


def plain(page):
    """Main text of the given pages, which all have one article of plain blocks."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", body))
    return "\n".join(t for p in parts if (t := re.sub(r"\s+", " ", html.unescape(p)).strip()))


def test_given_pages(spark, small):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in op10_html_text(spark, small).collect()}
    for r in given(small, "pages"):
        text = plain(r["html"])
        assert got[r["page_id"]] == (r["url"], text, len(text))


def test_awkward_pages(spark):
    run = "one two three four five six seven"
    pages = [
        (1, "http://h/1", f"<div>{run} <b>mine</b></div><p>First &amp; own<p>second", "r"),
        (2, "http://h/2", f"<p>Other text</p><div>{run}</div><form>x</form>", "r"),
        (3, "http://g/1", f"<p>{run}</p>", "r"),
        (4, "http://h/4", None, "r"), (5, None, "", "r"), (None, "", "<p>a\n b", "r"),
        (6, "x", "<main>t<div class='user-comments'>c</div><script>'</main>'</script> u</main>z", "r"),
        (7, "http://k/1", f"<p>{run} copy</p>", "r"), (8, "http://k/2", f"<p>{run} copy</p>", "r"),
        (9, "y", "<article>" + "<p>w</p>" * 5000, "r"),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, row string")
    got = {r.page_id: r.text for r in extract_text(table).collect()}
    assert got == {
        1: f"{run} mine\nFirst & own\nsecond", 2: "Other text", 3: run, 4: "", 5: "", None: "a b",
        6: "t\nu", 7: f"{run} copy", 8: f"{run} copy", 9: "\n".join(["w"] * 5000),
    }
    assert extract_text(table.limit(0)).count() == 0


def main_text(page):
    return [words for words, state in blocks(page) if state == "main"]


def test_class_names_count_as_whole_words():
    kept = ["class='social-science'", "class='share-price'", "class='story header'", "id='related-work'",
            "class='article-header'", "class='notice-period'", "class=''", "class"]
    gone = ["class='share-bar'", "class='x comments'", "id=user-comments", "class='ad'", "role='navigation'",
            "class='cookie-notice'", "class='left-sidebar'", "class='newsletter_box'"]
    for attribute in kept:
        assert main_text(f"<article><div {attribute}>a</div>b</article>") == ["a", "b"], attribute
    for attribute in gone:
        assert main_text(f"<article><div {attribute}>a</div>b</article>") == ["b"], attribute
    assert main_text("<article><header><h1 class='share'>t</h1></header>b</article>") == ["t", "b"]
    assert main_text("<header>x</header><article>b<header>t</header></article>") == ["b", "t"]


def test_tags_and_quotes():
    assert main_text("<main><p title='a > b' id=\"c>'d\">x</p>1 < 2 <b>y</b> 3>2</main>") == ["x", "1 < 2 y 3>2"]
    assert main_text("<main>a<!-- <p> -- > x -->b<!doctype z>c<br/>d</main><p>e") == ["abc", "d"]
    assert main_text("<main>a <p title=\"open>b</p> c</main>") == ["a", "b", "c"]
    assert main_text("<main>a</p></b><p>b</div>c<a href='x' end of it") == ["a", "b", "c<a href='x' end of it"]
    assert blocks("") == [] and blocks("<") == [("<", "plain")] and blocks("<!-- never closed") == []


def test_hostile_pages_take_linear_time():
    """Half a megabyte each of what makes naive readers start again and again."""
    for page in ("<a " * 170_000, "<a \"" * 130_000 + ">", "<a x='" * 80_000 + "\">", "<!" * 250_000,
                 "<div>" * 50_000 + "</x>" * 60_000, "<p><b>" * 80_000, "<div><p>" * 30_000 + "</div>" * 50_000,
                 "<!--" * 120_000, "</p>" * 120_000, "<" * 500_000, "&" * 500_000):
        start = time.process_time()
        blocks(page)
        assert time.process_time() - start < 4, page[:20]


def test_repeated_runs_go_as_blocks_or_when_long(spark):
    short, long = "starts as the end of the day comes near", " ".join(f"w{i}" for i in range(40))
    pages = [
        (n, f"http://h/{n}", f"<p>Body {n} {short} w{n}.</p><p>{short}</p><p>own {n} {long} {n} end</p>", "r")
        for n in range(4)
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, row string")
    got = {r.page_id: r.text for r in extract_text(table).collect()}
    assert got == {n: f"Body {n} {short} w{n}.\nown {n} {n} end" for n in range(4)}


def test_shared_passages_of_articles_stay(spark):
    line = "a passage that the articles of many pages on this host share word for word"
    pages = [(n, f"http://h/{n}", f"<nav>{line}</nav><article>{n}<p>{line}</article>", "r") for n in range(5)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, row string")
    assert {r.text for r in extract_text(table).collect()} == {f"{n}\n{line}" for n in range(5)}


def test_short_runs_side_by_side_are_no_long_run(spark):
    runs = [" ".join(f"r{i}w{j}" for j in range(8)) for i in range(6)]
    pages = [(0, "http://h/0", f"<p>Own start {' '.join(runs)} own end</p>")]
    pages += [(i, f"http://h/{i}", f"<p>Page {i}</p><p>{run}</p>") for i, run in enumerate(runs, 1)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(table).collect()}
    assert got == {0: f"Own start {' '.join(runs)} own end"} | {i: f"Page {i}" for i in range(1, 7)}


def test_blocks_that_most_articles_of_a_host_repeat_go(spark):
    line, quote = "please share this page with all your friends today", "a quote that six of the articles have"

    def article(n, inside):
        return f"<article><p>Own words of page {n} are many more than those others have too {n}</p>{inside}</article>"

    pages = [(n, "http://h/", article(n, f"<p>{line}</p>" + f"<p>{quote}</p>" * (n < 6))) for n in range(12)]
    # Less than half of the pages; too few pages; copies that have little of their own.
    pages += [(100 + n, "http://i/", article(n, f"<p>{line}</p>" if n < 12 else "")) for n in range(25)]
    pages += [(200 + n, "http://j/", article(n, f"<p>{line}</p>")) for n in range(9)]
    pages += [(300 + n, "http://k/", f"<main>{n}<p>{line}</p></main>") for n in range(12)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n")[1:] for r in extract_text(table).collect()}
    assert got == (
        {n: [quote] * (n < 6) for n in range(12)} | {100 + n: [line] * (n < 12) for n in range(25)}
        | {200 + n: [line] for n in range(9)} | {300 + n: [line] for n in range(12)}
    )


def test_neighbours_meet_across_partitions(spark):
    """Each partition of the order holds about one suffix."""
    pages = [(n, "http://h/", f"<p>own {n}</p><p>one two three four five six {n // 2}</p>") for n in range(6)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert {r.page_id: r.text for r in extract_text(table).collect()} == {n: f"own {n}" for n in range(6)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
