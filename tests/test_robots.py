import random
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from webgrain.operators import robots as R

TEXTS = [
    "User-agent: *\nDisallow: /private/\nAllow: /\n",
    "User-agent: Googlebot\nUser-agent: other\nDisallow: /a\nAllow: /a/b\n\nUser-agent: *\nDisallow:\n",
    "User-agent: *\nDisallow: /\n\nUser-agent: bot\nDisallow: /x # end\nCrawl-delay: 5\nRequest-rate: 1/10\n",
    "Disallow: /early\nUser-agent: bot\n\nDisallow: /late\nUser-agent: *\nDisallow: /z\n",
    "User-agent: a\nUser-agent: *\nDisallow: /q\nCrawl-delay: x\n\nUser-agent: *\nDisallow: /second",
    "user-agent : BOT\ndisallow : /caf%C3%A9/%20x\nallow: *\n",
    "User-agent: bot\nCrawl-delay: 3\nUser-agent: late\nDisallow: /l?\nAllow: /l\n",
    "", "nonsense\n\n:::\n", "User-agent:\nDisallow: /empty\n",
]
AGENTS = ["Googlebot", "bot/1.2", "late", "x"]
PATHS = ["", "/", "/a", "/a/b/c", "/private/x", "/x", "/z?q", "/q", "/second", "/café/ x", "/l?", "/l?a",
         "/caf%C3%A9/%20xy", "/empty", "/early", "/late#f"]


def test_decisions_equal_the_standard_parser(spark):
    rnd = random.Random(8)
    lines = ["User-agent: bot", "User-agent: *", "Disallow: /a", "Allow: /a/b", "Disallow: /",
             "", "# note", "Crawl-delay: 2", "Disallow:", "Allow: /"]
    texts = TEXTS + ["\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    df = spark.createDataFrame(
        [(i, t, p) for i, t in enumerate(texts) for p in PATHS], "i int, text string, path string")
    url = F.concat(F.lit("http://h.com"), F.col("path"))
    for agent in AGENTS:
        rules = R.agent_rules(R.parse_rules(F.col("text")), agent)
        got = df.select("i", "path", R.allows(rules, url).alias("ok"),
                        R.crawl_delay(rules).alias("delay"), R.request_rate(rules).alias("rate"))
        parsers = []
        for t in texts:
            parser = RobotFileParser()
            parser.parse(t.splitlines())
            parsers.append(parser)
        for r in got.collect():
            p = parsers[r["i"]]
            assert r["ok"] == p.can_fetch(agent, f"http://h.com{r['path']}"), (agent, texts[r["i"]], r)
            assert r["delay"] == p.crawl_delay(agent)
            rate = p.request_rate(agent)
            assert (r["rate"] and tuple(r["rate"])) == (rate and (rate.requests, rate.seconds))


def test_robots_allowed_joins_by_host(spark):
    urls = spark.createDataFrame(
        [("http://a.com/x", "a.com"), ("http://a.com/y", "a.com"), ("http://b.com/x", "b.com"),
         ("http://c.com/x", "c.com")], "url string, host string")
    robots = spark.createDataFrame(
        [("a.com", "User-agent: *\nDisallow: /x"), ("b.com", None)], "host string, robots_txt string")
    got = R.robots_allowed(urls, robots, "bot").select("url", "allowed").collect()
    assert dict(map(tuple, got)) == {
        "http://a.com/x": False, "http://a.com/y": True, "http://b.com/x": True, "http://c.com/x": True}


def test_rule_table(spark):
    df = spark.createDataFrame([("h", TEXTS[2])], "host string, text string")
    got = [tuple(r) for r in R.robots_rules(df, "host", "text").orderBy("line").collect()]
    assert got[0] == ("h", 0, 0, "user-agent", "*")
    assert [r[3] for r in got] == ["user-agent", "disallow", "user-agent", "disallow", "crawl-delay",
                                   "request-rate"]
    assert got[3][4] == "/x"


def test_visit_time(evaluate):
    texts = ["Visit-time 2-6", "a\nVisit-time: 0600-0845\nVisit-time 1-2", "Visit-time x-y", "none", ""]
    got = [tuple(r[0]) for r in evaluate(texts, "string", R.visit_time(F.col("v")))]
    assert got == [(2, 6), (600, 845), (None, None), (None, None), (None, None)]
