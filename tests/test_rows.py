import datetime as dt

import pytest
from pyspark.sql import functions as F

from webgrain.operators import enrich as N
from webgrain.operators import filters as P
from webgrain.operators import joins as J
from webgrain.operators import ordering as O
from webgrain.operators.keyed import apply_keyed

CAPTURE = ("urlkey string, timestamp string, url string, mime string, status string, languages string, "
           "encoding string, filename string, offset string, length string")


def capture(key, ts, status="200", languages="eng", url="http://a.com/"):
    return (key, ts, url, "text/html", status, languages, "UTF-8", "f", "0", "9")


def test_latest_capture_before_the_filter(spark):
    rows = [capture("k1", "2021"), capture("k1", "2022", status="404"), capture("k2", "2021"),
            capture("k2", "2023"), capture(None, "2020"), capture(None, "2021"),
            capture("k3", "2021", languages="eng,fra"), capture("k4", "2021", status=None)]
    df = spark.createDataFrame(rows, CAPTURE)
    latest = O.latest_per_key(df, "urlkey", "timestamp", ["url", "offset"])
    assert {(r["urlkey"], r["timestamp"]) for r in latest.collect()} == {
        ("k1", "2022"), ("k2", "2023"), (None, "2021"), ("k3", "2021"), ("k4", "2021")}
    kept = P.filter_captures(latest).collect()
    assert {(r["urlkey"], r["timestamp"]) for r in kept} == {("k2", "2023"), (None, "2021")}
    again = O.latest_per_key(latest, "urlkey", "timestamp", ["url", "offset"])
    assert sorted(map(str, again.collect())) == sorted(map(str, latest.collect()))


def test_latest_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([capture("k", "1")], CAPTURE)
    plan = O.latest_per_key(df, "urlkey", "timestamp", ["url"])._jdf.queryExecution().executedPlan()
    assert plan.toString().count("WindowGroupLimit") == 2


def test_nonempty_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "m string")
    assert [r[0] for r in P.filter_nonempty(df, "m").collect()] == ["a", None]


def test_required_counts_empty_as_missing(spark):
    df = spark.createDataFrame(
        [("q", ["r"], "m"), ("", ["r"], "m"), ("q", [], "m"), ("q", None, "m"), ("q", ["r"], None)],
        "user_query string, reference array<string>, model_response string")
    assert P.filter_required(df, ["user_query", "model_response"], ["reference"]).count() == 1


def test_prepare_items_numbers_before_dropping(spark):
    items = spark.createDataFrame(
        [(0, "s1", 0, "q", ["r"], "m"), (0, "s1", 1, "", ["r"], "m"), (0, "s1", 2, "q", ["r"], "m"),
         (1, "unknown", 0, "q", ["r"], "m"), (2, "s2", 0, "q", ["r"], "m"), (2, "s2", 1, "q", [], "m")],
        "system_ord int, system_id string, item int, user_query string, reference array<string>, "
        "model_response string")
    config = spark.createDataFrame([("s1", "v1"), ("s2", None)], "system_id string, prompt_tag string")
    got = P.prepare_items(items, config, "20240102030405").orderBy("eval_count").collect()
    assert [(r["run_id"], r["prompt_tag"]) for r in got] == [
        ("run_20240102030405_1", "v1"), ("run_20240102030405_3", "v1"),
        ("run_20240102030405_4", "unknown")]


def test_within_hours(spark):
    hours = spark.range(24).select(F.make_timestamp(
        F.lit(2024), F.lit(1), F.lit(1), F.col("id").cast("int"), F.lit(5), F.lit(0)).alias("ts"))
    ts = F.col("ts")
    assert hours.filter(P.within_hours(ts, F.lit(2), F.lit(6))).count() == 4
    assert hours.filter(P.within_hours(ts, F.lit(22), F.lit(3))).count() == 0  # no wrap
    assert hours.filter(P.within_hours(ts, F.lit(None).cast("int"), F.lit(6))).count() == 24


def test_flatten_metrics(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, None, None), (3, None, 2)], "id int, a double, b int")
    got = [tuple(r) for r in P.flatten_metrics(df, ["a", "b"], ["id"]).collect()]
    assert got == [(1, 0.5, None), (3, None, 2.0)]


def test_stringify_movies(spark):
    movies = spark.createDataFrame(
        [(dt.datetime(2019, 12, 20), "Star Wars: The Rise of Skywalker", "$275,000,000"),
         (dt.datetime(2018, 5, 25), "[red]Solo[/red]: A Star Wars Story", "$275,000,000")],
        "Date timestamp, Title string, `Production Budget` string")
    rows = P.stringify(movies, ["Date"]).orderBy("index").collect()
    assert [tuple(r) for r in rows] == [
        ("0", "2018-05-25 00:00:00", "[red]Solo[/red]: A Star Wars Story", "$275,000,000"),
        ("1", "2019-12-20 00:00:00", "Star Wars: The Rise of Skywalker", "$275,000,000")]


def test_null_keys_match_each_other(spark):
    a = spark.createDataFrame([("x",), (None,), ("y",), ("x",)], "Company string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "Company string, v int")
    got = sorted(map(str, J.left_join(a, b, "Company").collect()))
    assert len(got) == 5
    assert J.left_join(a, b, "Company", null_safe=False).filter("v is null").count() == 2
    picked = N.pick_companies(a, b)
    assert picked.count() == 3 and picked.filter("Company is null").count() == 0


def test_count_by_leaves_missing_out(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in J.count_by(df, "k").collect()] == [("a", 2)]


def test_trusted_counts_different_hosts(spark):
    hosts = ["www.cnn.com", "www.cnn.com", "x.com"]
    listed = ["www.cnn.com", "www.reuters.com", "www.reuters.com"]

    def ok(found):
        return spark.range(1).select(J.trusted(F.array(*map(F.lit, found)), listed, 2)).first()[0]

    assert not ok(hosts)
    assert not ok(["www.reuters.com"])
    assert ok(hosts + ["www.reuters.com"])


HITS = [
    ("Acme", 1, "https://www.cnn.com/acme"), ("Acme", 2, "https://en.wikipedia.org/wiki/Acme%20Inc+Co"),
    ("Acme", 3, "https://en.wikipedia.org/wiki/Other"),
    ("Solo", 1, "https://en.wikipedia.org/wiki/Solo"), ("Solo", 2, "https://en.wikipedia.org/wiki/Solo2"),
    ("None", 1, "https://www.cnn.com/x"), ("None", 2, "https://apnews.com/x"),
    ("Port", 1, "https://en.wikipedia.org:443/wiki/P"), ("Port", 2, "https://www.cnn.com/p"),
]


def test_enrichment(spark):
    hits = spark.createDataFrame(HITS, "query string, rank int, url string")
    titles = N.first_article_title(hits)
    assert dict(map(tuple, titles.collect())) == {"Acme": "Acme Inc+Co", "Solo": "", "None": "", "Port": ""}
    responses = spark.createDataFrame(
        [("Acme Inc+Co", '{"query":{"pages":{"1":{"extract":"About Acme"}}}}')], "title string, body string")
    full = N.enrich(titles.withColumnRenamed("query", "Company"), responses)
    assert {r["Company"]: r["content"] for r in full.collect()} == {
        "Acme": "About Acme", "Solo": None, "None": None, "Port": None}


def test_verdicts(spark):
    sites = spark.createDataFrame([("a",), ("b",), ("c",)], "site string")
    answers = spark.createDataFrame(
        [("a", 0, "1"), ("a", 1, "0."), ("b", 0, "2"), ("b", 1, "1")], "site string, chunk int, answer string")
    assert dict(map(tuple, J.fold_verdicts(sites, answers).collect())) == {"a": False, "b": True, "c": True}


def test_mirror_plan(spark):
    t = [dt.datetime(2024, 1, i) for i in (1, 2, 3)]
    src = spark.createDataFrame([("new", t[0]), ("newer", t[2]), ("older", t[0]), ("same", t[1])],
                                "path string, mtime timestamp")
    dst = spark.createDataFrame([("extra", t[0]), ("newer", t[1]), ("older", t[1]), ("same", t[1])],
                                "path string, mtime timestamp")
    assert dict(map(tuple, J.mirror_plan(src, dst).collect())) == {
        "new": "copy", "newer": "copy", "older": "skip", "same": "skip", "extra": "delete"}


def test_samples(spark):
    df = spark.range(50)
    a, b = (O.sample_exact(df, "id", 10, seed=1).collect() for _ in range(2))
    assert a == b and len({r[0] for r in a}) == 10
    with pytest.raises(ValueError):
        O.sample_exact(df, "id", 51)
    ranks = O.shuffle(df, "id", seed=3).collect()
    assert sorted(r["rank"] for r in ranks) == list(range(1, 51))
    assert [r["id"] for r in sorted(ranks, key=lambda r: r["rank"])] != list(range(50))


def test_chunks(spark):
    got = dict(map(tuple, O.chunk_id(spark.range(7), ["id"], 3).collect()))
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2}


def test_frontier_patterns(spark):
    df = spark.createDataFrame(
        [("a", "http://a/about"), ("a", "http://a/x"), ("b", "http://b/about"), ("a", "http://a/1/2/3/4")],
        "domain string, url string")
    starts = spark.createDataFrame([("a",)], "domain string")
    assert P.frontier(df, "url", starts).count() == 2
    assert P.frontier(df, "url", starts, patterns=["about", "contact"]).count() == 1


def test_apply_keyed(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    got = apply_keyed(df, "k", lambda k: None if k == "b" else k * 2).collect()
    assert [tuple(r) for r in got] == [("a", "aa")]


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert J.concat(a, b).filter("v is null").count() == 3
    assert [r[0] for r in J.common(a.select("id"), b).collect()] == [1]
    assert tuple(J.shape(a).first()) == (2, 2)


def test_missing_order_value_is_the_latest(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", None, 2), ("b", "3", 3), ("b", "4", 4)], "k string, t string, i int")
    assert {r["i"] for r in O.latest_per_key(df, "k", "t", ["i"]).collect()} == {2, 4}


def test_default_only_where_there_is_no_row(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    known = spark.createDataFrame([("a", "x"), ("b", None)], "k string, v string")
    assert {r["k"]: r["v"] for r in P.lookup_default(df, known, "k", "v", "d").collect()} == {"a": "x", "b": None, "c": "d"}
