"""Quality rules, sharding, secret scans, page wrappers and the pipeline."""

import hashlib
import math
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from webgrain.llm import quality, secrets, sharding, wrappers
from webgrain.llm.common import fresh, stored


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    vocab = "the of and to a in is that it for on was tree river stone cloud bird, house. Road\n".split(" ")
    make = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [make(rng.randint(0, 300)) for _ in range(40)]
    texts += [texts[1], texts[1], None, "", " \n\t", "a b c " * 40, "### $$$ *** " * 60, "line one\nline one\n\n \nline one",
              "x" * 20000, "X&Y|Z <a> 100% $5 #1 *\n*", "é ü 中文 words\x0bhere\x0cand\rthere"]
    rows = [(k, t, ["en", "de", None, "xx"][k % 4] if k > 30 else "en", "z") for k, t in enumerate(texts)]
    rows += [(None, make(80), "en", "z"), (3, texts[3], "en", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _t string").repartition(3)


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    again = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_quality_counts_and_guards(docs):
    out = quality.rate(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        n = base_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.base_failed and r.kept)
    junk = [r for r in out if r.text and r.text.startswith("###")]
    assert junk and not any(r.kept for r in junk)
    assert any(r.kept for r in out)
    assert quality.rate(docs.limit(0)).count() == 0


def test_divergence_alone_rejects(spark):
    rng = random.Random(9)
    plain = [" ".join(rng.choice("the of and to a in tree house river stone walks slowly".split()) for _ in range(150))
             for _ in range(30)]
    odd = " ".join(f"w{rng.randint(0, 10 ** 6)}### x{rng.randint(0, 999)}%%%" for _ in range(90))
    out = quality.rate(spark.createDataFrame([(k, t, "en") for k, t in enumerate([*plain, odd])], "doc_id long, text string, lang string")).collect()
    assert {r.doc_id for r in out if not r.kept} == {30}
    assert not next(r for r in out if r.doc_id == 30).base_failed


def test_jensen_shannon(spark):
    rows = [([1, 2, 3], [1, 2, 3]), ([1, 0], [0, 5]), ([0, 0], [1, 1]), ([3, 1], [1, 1])]
    got = [r[0] for r in spark.createDataFrame(rows, "p array<long>, q array<long>").select(
        quality.jensen_shannon(F.col("p"), F.col("q"))).collect()]

    def js(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        half = lambda a: sum(x * math.log2(2 * x / (x + y)) for x, y in a if x)
        return math.sqrt((half(zip(p, q)) + half(zip(q, p))) / 2)

    assert got[2] is None and got[0] == 0 and got[1] == pytest.approx(1) and got[3] == pytest.approx(js(*rows[3]))


@pytest.mark.parametrize("shards,rows_per_task", [(24, 1000), (5, 2), (1, 7)])
def test_shards(docs, shards, rows_per_task):
    rows = docs.collect()
    out = sharding.shard(docs, shards, rows_per_task=rows_per_task).collect()
    want = sorted(((r.doc_id or -1), len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sorted(((r.doc_id if r.doc_id else (0 if r.doc_id == 0 else -1)) or -1 if r.doc_id is None else r.doc_id or -1,
                   r["size"], r.text_crc32) for r in out) == want
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    for s in range(shards):
        mine = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / shards) <= largest + 0.01 * total
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_shards_of_one_group_and_of_nothing(spark):
    same = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("equal text").alias("text"))
    counts = [r["count"] for r in sharding.shard(same, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 2
    again = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("equal").alias("text"))
    counts = [r["count"] for r in sharding.shard(again, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 2
    assert sharding.shard(same.limit(0), 8).count() == 0


PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
     lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m)]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(8)
    parts = ["password=hunter2x", "token=token:abcdefghij", "API_KEY: 'abc'", "é token = \"" + "ab" * 20 + "\"", "AKIA" + "Z" * 16,
             "AKIAAKIA" + "Q" * 12, "AKIAshort", "0123456789abcdef" * 2, "secret==abcdef", "passwd : x", "日本 ", " and ", "\n",
             "ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(80)] + [None, "", "password"]
    return spark.createDataFrame([(k, t, "b", "f") for k, t in enumerate(texts + texts[:9])], "doc_id long, text string, _b string, findings string")


def test_secret_spans(spark, leaks):
    out = secrets.scan(leaks, fresh(spark, "ledger"))
    text = {r.doc_id: r.text for r in leaks.collect()}
    kinds = [r.kind for r in secrets.BASE_RULES]
    got = out.select("doc_id", secrets.listed(F.col("findings"), kinds).alias("base"),
                     secrets.listed(F.col("findings"), ["hosting_token", "private_key"]).alias("more")).collect()
    assert {r.doc_id: r.base for r in got} == {k: base_spans(t) for k, t in text.items()}
    assert all((r.more != "") == bool(re.search("ghp_|PRIVATE KEY", text[r.doc_id] or "")) for r in got)
    assert secrets.scan(leaks.limit(0), fresh(spark, "ledger")).count() == 0


def test_only_unseen_pairs_are_scanned(spark, leaks):
    path = fresh(spark, "ledger")
    secrets.scan(leaks.filter("doc_id < 40"), path, secrets.BASE_RULES)
    first = spark.read.parquet(path).count()
    secrets.scan(leaks.filter("doc_id < 40"), path, secrets.BASE_RULES)
    assert spark.read.parquet(path).count() == first
    blobs = leaks.select(F.coalesce("text", F.lit(""))).distinct().count()
    secrets.scan(leaks, path, secrets.BASE_RULES)
    assert spark.read.parquet(path).count() == 3 * blobs
    newer = (*secrets.BASE_RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]+", 0, 40))
    out = secrets.scan(leaks, path, newer)
    assert spark.read.parquet(path).count() == 4 * blobs
    assert all(f.stop - f.start >= 40 for r in out.collect() for f in r.findings if f.kind == "hex")


def test_masking(spark, leaks):
    out = {r.doc_id: r.text for r in secrets.mask(leaks, fresh(spark, "ledger")).collect()}
    for r in leaks.collect():
        spans = sorted((int(a), int(b)) for a, b in re.findall(r":(\d+):(\d+)", base_spans(r.text)))
        if r.text is None or (not spans and "ghp_" not in r.text and "PRIVATE" not in r.text):
            assert out[r.doc_id] == r.text
        for a, b in spans:
            assert r.text[a:b] not in out[r.doc_id] or r.text[a:b] in "[REDACTED]"


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<nav><ul><li><a href='/'>Home</a><li>More</ul></nav><div class=\"ad top\">Buy</div>%s<footer>&copy; x</footer></body></html>")


def brute_mask(text, spans):
    out, at = [], 0
    for start, stop in sorted(spans):
        if start >= at:
            out += [text[at:start], "[REDACTED]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def test_very_many_secrets_in_one_text(spark):
    """Places and masks of 100,000 findings, over characters of one to four bytes; also runs of overlapping
    findings longer than a block, and a finding that ends the text."""
    key = "0123456789abcdef" * 2
    many = "".join(f"é𝄞 {key[i % 7:]}\n" for i in range(100_000))
    overlap = "x token=" + "ab12" * 400 + " y AKIA" + "A" * 700 + "=" + key
    rows = [(1, many), (2, overlap), (3, key), (4, "é" * 1024 + key), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    began = time.time()
    spans = {r.doc_id: [(f.start, f.stop) for f in r.findings] for r in secrets.scan(docs, fresh(spark, "ledger")).collect()}
    assert spans[1] == [m.span() for m in re.finditer("[0-9a-f]{24,}", many)]
    assert {m.span() for m in re.finditer("[0-9a-f]{24,}", overlap)} <= set(spans[2]) and (2, 1608) in spans[2]
    masked = {r.doc_id: r.text for r in secrets.mask(docs, fresh(spark, "ledger")).collect()}
    assert time.time() - began < 60
    assert masked == {i: text and brute_mask(text, spans[i]) for i, text in rows}


@pytest.mark.parametrize("body,text", [
    ("<article><h1>A &amp; B</h1><p>one <b>two</b>three<br>four<p>five\n six</article>", "A & B one twothree four five six"),
    ("<main><p>one<aside>side</aside><p>two<form><input>f</form><div id='comments'><p>c</div></main>", "one two"),
    ("<article><header><h1>Head</h1><p>by me</p></header><p>x<div class='share-buttons'>s</div><footer>f</footer></article>", "Head x"),
    ("<article></article>", ""),
    ("<article><p>a<![foo]>b<!-- c --><p>d <3 e < f</article>", "ab d <3 e < f"),
])
def test_page_text(spark, body, text):
    pages = spark.createDataFrame([(1, "http://h.example/1", PAGE % body, "k")], "page_id long, url string, html string, host string")
    r = wrappers.extract(pages).first()
    assert (r.text, r.n_chars) == (text, len(text))


def test_page_without_article_uses_the_wrapper(spark):
    rows = [(k, "http://h.example/%d" % k, PAGE % (
        f"<div class=story><div class=note2>Same on all</div><p>{'body %d ' % k * 20}</p>"
        + "<p>more</p>" * (k % 3) + "</div><div class=sidebar>s</div>")) for k in range(6)]
    rows += [(90, None, None), (91, "", ""), (92, "http://h.example/x", "plain <b>text</b>")]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4].startswith("body 4 body 4") and "Same" not in got[4] and "Buy" not in got[4] and got[4].endswith("more")
    assert got[90] == got[91] == ""


def test_layouts_of_one_host_have_their_own_region(spark):
    body = "<p>Long text of page %d goes on and on.</p>"
    rows = [(0, "http://m.example/0", PAGE % f"<article>{body % 0}</article>")]
    rows += [(k, f"http://m.example/{k}", PAGE % f"<div id=content>{body % k}</div><div class=sidebar>s</div>") for k in range(1, 6)]
    rows += [(6, "http://m.example/6", PAGE % f"<main>{body % 6}</main>")]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Long text of page {k} goes on and on." for k in range(7)}


@pytest.mark.parametrize("open_,close", [
    ("<article class='post has-sidebar'>", "</article>"), ("<div class='content no-comments'>", "</div>"),
    ("<main id='main-with-sidebar' class='share'>", "</main>")])
def test_class_words_that_tell_a_state_are_no_role(spark, open_, close):
    rows = [(k, f"http://s.example/{k}", PAGE % f"{open_}<p>text {k} of it</p>{close}<div class='cookie-banner'>no</div>") for k in range(3)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"text {k} of it" for k in range(3)}


def test_alignment_makes_optional_and_repeated_groups():
    a = wrappers.read_page("<div><h1>x</h1><p>a<p>b</div>")[1]
    b = wrappers.read_page("<div><p>a<p>b<ul><li>x</ul></div>")[1]
    w = wrappers.align(a, b)
    assert wrappers.expression(w) == "<div> (<h1>)? (#)? (</h1>)? (<p> # </p>)+ (<ul>)? (<li>)? (#)? (</li>)? (</ul>)? </div>"
    assert wrappers.align(w, a) == w
    assert wrappers.slots(w) == ["div/h1", "div/p", "div/ul/li"]


def test_broken_pages_take_linear_time():
    for s in ("<a " * 100000, "<!--" * 50000, "<p x='" * 50000, "</" * 50000, "<div>" * 20000, "<![x]>" * 50000):
        wrappers.read_page(s)


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(6)
    make = lambda n: " ".join(rng.choice("the of and to a in tree house river stone walks slowly".split()) for _ in range(n))
    item = "Every red river of that old land runs to one deep cold sea in spring"
    first = make(150)
    rows = [(10, first), (4, first), (4, first), (7, first + " end"), (11, make(160) + " " + item), (12, make(120) + " password=abcdef123"),
            (13, "short"), (14, None), (15, "### " * 80), (None, make(140))]
    rows += [(100 + k, make(150)) for k in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "t")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = [r.doc_id for r in docs.collect()]
        if name == "quality rules":
            assert not {13, 14, 15} & set(ids) and len(ids) == 27
        if name == "MinHash near-dedup":
            assert sorted(x for x in ids if x in (4, 7, 10)) == [4] and None in ids
        if name == "benchmark decontamination":
            assert 11 not in ids
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(ids) == {4, 12, None, *range(100, 120)}
    assert out[12].text.endswith("[REDACTED]") and out[12].n_chars == len(out[12].text)
    assert out[4].text == first and out[4].n_tokens == len(out[4].ids) > 100
    assert hashlib.sha256(out[4].text.encode()).hexdigest() == hashlib.sha256(first.encode()).hexdigest()


def test_queries_are_registered():
    from webgrain.llm.queries import QUERIES

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
