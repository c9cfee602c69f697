import random
from urllib.parse import unquote, urljoin, urlparse

from pyspark.sql import functions as F

from webgrain.functions import urls as U
from webgrain.operators.domains import registered_domain
from webgrain.plans.scale import local_table

V = F.col("v")
BASES = ["http://h.com", "http://h.com/", "https://h.com/a/b", "https://h.com/a/b/",
         "http://h.com/a//b/c?q=1#f", "http://u@h.com:80/x;p?y"]


def test_resolve_equals_urljoin(spark):
    rnd = random.Random(4)
    parts = ["", "a", "..", ".", "b.html", "x"]
    refs = ["mailto:x", "https://z.com/q", "//o.org/z", "a;b", "%20", "?q=1", "#f", "///x", "//?a"]
    pairs = [(b, r) for b in BASES for r in refs]
    for b in BASES:
        for _ in range(120):
            path = rnd.choice(["", "/"]) + "/".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5)))
            pairs.append((b, path + rnd.choice(["", "?q=1", "#f", "?a#b"])))
    df = spark.createDataFrame(pairs, "b string, h string").coalesce(1)
    got = df.select("b", "h", U.resolve(F.col("b"), F.col("h"))).collect()
    assert [(b, h, x) for b, h, x in got if x != urljoin(b, h)] == []


def test_parts_equal_urlparse(evaluate):
    urls = BASES + ["//h.com/p", "no-scheme/path;x", "https://www.two Words.com/", "http://a_b.com/",
                    "http://h.com/a;b/c;d?e", ""]
    got = evaluate(urls, "string", U.netloc(V), U.path(V), U.scheme(V))
    assert got == [(p.netloc, p.path, p.scheme) for p in map(urlparse, urls)]


def test_unquote_keeps_plus_and_bad_escapes(evaluate):
    texts = ["a%20b", "a+b", "%zz%2", "caf%C3%A9", "100%", "%2B", ""]
    assert [r[0] for r in evaluate(texts, "string", U.unquote(V))] == [unquote(t) for t in texts]


def test_small_ones(evaluate):
    got = evaluate(["h.com", "http://h.com", "https://h.com/a/"], "string",
                   U.normalize_url(V), U.robots_url(V), U.depth(V))
    assert got[0][0] == "http://h.com/"
    assert got[1] == ("http://h.com/", "http://h.com/robots.txt", 0)
    assert got[2] == ("https://h.com/a/", "https://h.com/robots.txt", 2)


def test_registered_domain(spark):
    cases = {
        "https://www.ab.com/": "ab.com",
        "www.cde.com/global": "cde.com",
        "https://www.two Words.com/": None,
        "https://www.some words.com/": None,
        "http://a.b.example.co.uk:8080/x": "example.co.uk",
        "http://user@shop.net/": "shop.net",
        "http://127.0.0.1/": None,
        "http://host.unknown/": None,
        "http://com/": None,
        "http://my_host.org": "my_host.org",
        "https://": None,
        "": None,
        None: None,
    }
    suffixes = local_table(spark, [(s,) for s in ("com", "net", "org", "co.uk", "uk")], "suffix string")
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    for labels in (None, 2):
        got = registered_domain(df, "url", suffixes, max_labels=labels).collect()
        assert {r["url"]: r["domain"] for r in got} == cases


def test_domain_lookup_is_broadcast_and_shuffles_nothing(spark):
    suffixes = local_table(spark, [("com",), ("co.uk",)], "suffix string")
    df = spark.createDataFrame([("http://a.com",)], "url string")
    plan = registered_domain(df, "url", suffixes, max_labels=2)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_domain_rules_with_wildcards_and_exceptions(spark):
    cases = {"http://www.ck/": "www.ck", "http://a.www.ck/": "www.ck", "http://x.ck/": None, "http://a.x.ck/": "a.x.ck",
             "http://b.a.x.ck/": "a.x.ck", "http://ck/": None, "http://a.jp/": "a.jp", "http://b.kobe.jp/": None,
             "http://c.b.kobe.jp/": "c.b.kobe.jp", "http://city.kobe.jp/": "city.kobe.jp"}
    rules = [(s,) for s in ("*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp")]
    suffixes = local_table(spark, rules, "suffix string")
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    for labels in (None, 3):
        got = registered_domain(df, "url", suffixes, max_labels=labels).collect()
        assert {r["url"]: r["domain"] for r in got} == cases
