import pytest
from pyspark.sql import functions as F

from webgrain.functions import dom as D
from webgrain.operators import crawl as C

PAGE = """<!DOCTYPE html><html><head><title>Home &amp; more</title>
<meta charset="utf-8"><meta name="description" content="We sell">
<style>p{margin:0}</style><script>var t="</p>"; about();</script></head><body class="x">
<!-- hidden --><p>First <b>bold<p>second</p> tail
<a href="/legal/terms-of-use">Rules</a><a href="x.html"><span>TERMS of use</span></a>
<a href="/we-are/about_us">Info</a><a>no href</a><a href="/us">United States</a>
<div class="a popup" role="dialog" id="main-content">  sub<i>scribe</i> </div>
<button role="button" type="submit"> Log <b>in</b> </button><input type="text" value="login">
"""


def page(spark, html, url="http://site.com/", tags=None):
    df = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    return C.shred(df, tags=tags)


def value(df, column):
    return df.select(column).first()[0]


d, u = F.col("dom"), F.col("url")


def test_reader_nesting_and_text():
    got = D.read_page(PAGE)
    tags = [n["tag"] for n in got["nodes"]]
    assert tags.count("p") == 2 and tags.count("script") == 1
    assert "hidden" not in "".join(got["texts"]) and "about()" not in "".join(got["texts"])
    body = next(n for n in got["nodes"] if n["tag"] == "body")
    assert body["end_ord"] == len(tags) and body["t1"] == len(got["texts"])
    second_p = [n for n in got["nodes"] if n["tag"] == "p"][1]
    assert second_p["depth"] == 4  # html, body, p, b: nothing is closed for it
    assert second_p["string"] == "second"


def test_reader_end_tags():
    got = D.read_page("<div><b>x</div>y</b></p>z<br>w</br>")
    assert [(n["tag"], n["t0"], n["t1"]) for n in got["nodes"]] == [("div", 0, 1), ("b", 0, 1), ("br", 3, 3)]
    assert got["texts"] == ["x", "y", "z", "w"]


def test_reader_single_string_goes_through_only_children():
    got = D.read_page("<a><span>deep</span></a><p>x<i>y</i></p><u><!--note--></u><q></q>")
    assert [n["string"] for n in got["nodes"]] == ["deep", "deep", None, "y", "note", None]


def test_reader_blank_pieces_and_entities():
    got = D.read_page("<p> \t </p>\n\n <pre>  </pre>&copy;&am&amp x<textarea> a</textarea>")
    assert got["texts"] == [" ", "\n", "  ", "©&am& x", " a"]
    assert D.read_page(None) is None
    assert D.read_page("") == {"nodes": [], "texts": []}


def test_reader_keeps_only_named_tags():
    got = D.read_page("<div><p>x</p></div>", {"p"})
    assert [(n["tag"], n["ord"]) for n in got["nodes"]] == [("p", 1)]


def test_page_text_and_metadata(spark):
    df = page(spark, PAGE)
    assert value(df, D.page_text(d)).split("\n")[:2] == ["Home & more", "First boldsecond tail"]
    home = "Home Page of the company | Home & more"
    assert value(df, D.url_metadata(d, u)) == f"{home}. We sell"
    assert value(df, D.url_metadata(d, F.lit("http://s.com/x"))) == "Home & more. We sell"
    assert value(df, D.url_metadata(d, u, fallback=False)) == "Home & more. We sell"


@pytest.mark.parametrize("html,with_fallback,without", [
    ("<title>T</title>", "T", None),
    ("<title>T</title><meta name='description'>", "T", None),
    ("<title>T</title><meta name='Description' content='x'>", "T", None),
    ("<p>no title</p>", None, None),
])
def test_metadata_fallback(spark, html, with_fallback, without):
    df = page(spark, html, "http://s.com/x")
    assert value(df, D.url_metadata(d, u)) == with_fallback
    assert value(df, D.url_metadata(d, u, fallback=False)) == without


def test_page_items_need_a_body(spark):
    assert C.page_items(page(spark, "<title>t</title><p>x</p>")).count() == 0
    row = C.page_items(page(spark, "<title>t</title><body> a <b>b</b><script>s</script>\n c")).first()
    assert tuple(row) == ("http://site.com/", "t", "a\nb\nc")


def test_terms_link_order(spark):
    assert value(page(spark, PAGE), D.terms_link(d, u)) == "http://site.com//x.html"
    by_address = "<a href='/b/user-agreement'>x</a><a href='http://o.com/Terms-Of-Use'>y</a>"
    assert value(page(spark, by_address), D.terms_link(d, u)) == "http://o.com/Terms-Of-Use"
    relative = value(page(spark, "<a href='//b/user-agreement'>x</a>", "site.com"), D.terms_link(d, u))
    assert relative == "http://site.com//b/user-agreement"
    assert value(page(spark, "<a href='/x'>y</a>"), D.terms_link(d, u)) is None


def test_about_and_region_links(spark):
    df = page(spark, PAGE)
    assert value(df, D.about_link(d, u)) == "http://site.com/we-are/about_us"
    assert value(df, D.region_link(d, u)) == "http://site.com/us"
    first = "<a href='t'> Our-Team </a><a href='/about'>x</a>"
    assert value(page(spark, first), D.about_link(d, u)) == "http://site.com/t"
    assert value(page(spark, "<a href='/x'>about it</a>"), D.about_link(d, u)) is None
    assert value(page(spark, "<a href='/x'>US</a>"), D.region_link(d, u)) is None


def test_popup_evidence_order(spark):
    def found(html):
        return tuple(C.popup_evidence(page(spark, html)).first())

    assert found(PAGE) == (True, "text", "div", "subscribe")
    assert found("<footer>We accept</footer><article>cookies</article>") == (True, "text", "article", "cookies")
    assert found("<div>go</div><div>agree to the terms</div>") == (True, "text", "div", "terms")
    assert found("<p class='big modal'>x</p>") == (True, "selector", "p", ".modal")
    assert found("<p id='overlay-background'>x</p>") == (True, "selector", "p", "#overlay-background")
    assert found("<p aria-modal='true'>x</p><b role='dialog'>y</b>") == (
        True, "selector", "b", "[role='dialog']")
    assert found("<p class='popups'>terms</p>") == (False, None, None, None)
    # pieces are stripped and joined without a separator
    assert found("<div>te<b> r</b>ms</div>") == (True, "text", "div", "terms")
    assert found("<div>te<b> r r</b>ms</div>") == (False, None, None, None)


def test_role_elements(spark):
    rows = C.role_elements(page(spark, "<i role=button> b </i><p role=alert>a1</p><p role=alert>a2</p>"))
    assert [(r["role"], r["text"]) for r in rows.collect()] == [
        ("alert", "a1"), ("alert", "a2"), ("button", "b")]


def test_interaction_evidence(spark):
    rows = C.interaction_evidence(page(spark, PAGE)).collect()
    # "Log" and "in" join to "login"; the input has no text and never counts
    assert [(r["selector"], r["text"]) for r in rows] == [("button[type='submit']", "login")]
    html = ("<button type='submit'>Log<b>in</b></button><input type='text' value='login'>"
            "<a href='/x/login'>Sign in</a><a href='/login'>go</a><iframe>email</iframe>")
    got = [(r["selector"], r["tag"], r["text"]) for r in C.interaction_evidence(page(spark, html)).collect()]
    assert got == [("button[type='submit']", "button", "login"), ("a[href*='login']", "a", "sign in"),
                   ("iframe", "iframe", "email")]


def test_text_by_id(spark):
    df = page(spark, PAGE)
    assert value(df, D.text_by_id(d, "div", "main-content")) == "  subscribe "
    assert value(df, D.text_by_id(d, "p", "main-content")) is None


def test_link_edges(spark):
    html = "<a href='/a'>1</a><a href='http://x.site.com/b'>2</a><a href='/a'>3</a><a href='http://o.com'>4</a>"
    df = page(spark, html, "http://site.com/p")
    assert [tuple(r) for r in C.link_edges(df).collect()] == [
        ("http://site.com/p", 0, "http://site.com/a"), ("http://site.com/p", 1, "http://x.site.com/b"),
        ("http://site.com/p", 2, "http://o.com")]
    inside = C.link_edges(df, ["site.com"]).select("dst").collect()
    assert [r[0] for r in inside] == ["http://site.com/a", "http://x.site.com/b"]
    assert C.link_edges(df, ["ite.com"]).count() == 0


def test_first_links_by_class(spark):
    html = "".join(f"<a class='{'rEAWd z' if i % 2 else 'o'}' href='/{i}'>x</a>" for i in range(20))
    rows = C.first_links(page(spark, html), "rEAWd", 5, "https://s.com").collect()
    assert [r["link"] for r in rows] == [f"https://s.com/{i}" for i in (1, 3, 5, 7, 9)]


def test_pages_are_parsed_once(spark):
    df = page(spark, PAGE)
    items = C.page_items(df).filter(F.length("body") > 3)
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("html,texts", [
    ("a<![foo]>b", ["a", "b"]), ("a<![CDATA[x<y]]>b", ["a", "x<y", "b"]), ("a<!x>b<?y>c", ["a", "b", "c"]),
    ("a<!-- never closed", ["a"]), ("a<![", ["a"]), ("a<!", ["a"]), ("x < y <3 <", ["x < y <3 <"]),
    ("<p a='b>c", ["c"]), ("<p>a</p", ["a"]), ("<script>if (a < b) {", []), ("a</>b", ["ab"]),
])
def test_broken_markup_is_read_on(html, texts):
    assert D.read_page(html)["texts"] == texts


@pytest.mark.parametrize("piece", ["<a <a ", "<!--", "<p x='", "</", "<", "<![", "<a b", "</p <"])
def test_broken_markup_takes_linear_time(piece):
    import time

    started = time.time()
    D.read_page(piece * (1_000_000 // len(piece)))
    assert time.time() - started < 4


def test_link_patterns_and_page_flag(spark):
    from webgrain.operators import crawl as C

    html = ["<a href='/a/1'>x</a><a href='/b/2'>y</a><a href='/a/3'>z</a>", "<input type='text'>", "<div role='dialog'>Please  LOG in</div>"]
    pages = C.shred(spark.createDataFrame([(k, "http://h.example/", t) for k, t in enumerate(html)], "id int, url string, html string"))
    edges = C.link_edges(pages, keep=["id"], patterns=["/a/", "nothing"]).orderBy("ord").collect()
    assert [(r.ord, r.dst) for r in edges] == [(0, "http://h.example/a/1"), (2, "http://h.example/a/3")]
    assert C.link_edges(pages, patterns=[]).count() == 0
    flags = C.interaction_needed(pages, ["input[type='text']", "div[role='dialog']"], ["log in"], keep=["id"])
    assert {r.id: r.flag for r in flags.collect()} == {0: False, 1: False, 2: True}
