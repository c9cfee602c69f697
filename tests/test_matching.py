import random

import pytest
from pyspark.sql import functions as F

from webgrain.operators import matching as M

CATALOG = ["travel", "points", "cashback", "dining", "groceries", "free", "cars", "gap", "lyft",
           "united", "prime", "offer", "lyft offers", "prime offers"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def catalog(spark, terms):
    return spark.createDataFrame(list(enumerate(terms)), "pos int, term string")


def queries(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "query string")


def test_demo_queries(spark):
    asked = ["fee", "care", "gas", "lift", "point", "crime", "zzzzz"]
    got = M.match_edit1(queries(spark, asked), catalog(spark, CATALOG)).collect()
    assert {(r["query"], r["term"]) for r in got} == {
        ("fee", "free"), ("care", "cars"), ("gas", "gap"), ("lift", "lyft"), ("point", "points"),
        ("crime", "prime"), ("zzzzz", None)}


@pytest.mark.parametrize("k,size", [(1, 8), (2, 6), (3, 5)])
def test_equal_to_brute_force(spark, k, size):
    rnd = random.Random(k)
    words = ["", "a", "é", "ab", "ba"] + [
        "".join(rnd.choice("abé") for _ in range(rnd.randint(0, size))) for _ in range(80)]
    terms = words[:50] + words[:5]  # repeated terms keep their positions
    got = M.match_edit(queries(spark, words), catalog(spark, terms), k).filter("pos is not null")
    want = {(q, i, t) for q in set(words) for i, t in enumerate(terms) if distance(q, t) <= k}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == want


@pytest.mark.parametrize("k", [2, 3, 4])
def test_segments_equal_brute_force(spark, k):
    """Terms near each other, longer than the edits; with and without segments that many terms share."""
    rnd = random.Random(10 + k)

    def edited(word):
        word = list(word)
        for _ in range(rnd.randint(0, k + 1)):
            at = rnd.randrange(len(word) + 1)
            change = rnd.choice(["add", "drop", "swap"])
            if change == "add":
                word.insert(at, rnd.choice("abcé"))
            elif at < len(word):
                word[at:at + 1] = [] if change == "drop" else [rnd.choice("abcé")]
        return "".join(word)

    roots = ["".join(rnd.choice("abcdefé") for _ in range(rnd.randint(5, 16))) for _ in range(25)]
    words = sorted({edited(rnd.choice(roots)) for _ in range(120)} | {"", "a", "bc", "abé"})
    want = {(q, t) for q in words for t in words if distance(q, t) <= k}
    for shared in (1000,) if k == 4 else (1000, 2):
        rows = [tuple(r) for r in M.match_terms(queries(spark, words), catalog(spark, words), k, shared=shared).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    assert len(want) > 2 * len(words)


def test_number_of_keys_depends_on_the_edits_alone(spark):
    for k in (2, 3):
        sizes = []
        for n in (20, 200, 2000):
            one = spark.createDataFrame([("".join(chr(97 + i * i % 26) for i in range(n)),)], "t string")
            sizes.append(one.select(F.size(M._segment_keys(F.col("t"), k)), F.size(M._segment_probes(F.col("t"), k))).first())
        assert all(a == k + 1 and b <= (k + 1) ** 3 for a, b in sizes)
        assert sizes[1] == sizes[2]


def test_a_shared_prefix_is_no_key(spark):
    """Two thousand terms with one prefix: candidates stay near the true matches."""
    words = [f"Customer#{i * 7919 % 10 ** 6:06d}" for i in range(2000)]
    got = M.match_terms(queries(spark, words[:50]), catalog(spark, words), 2, shared=100)
    want = {(q, t) for q in words[:50] for t in words if sum(a != b for a, b in zip(q, t)) <= 2 or distance(q, t) <= 2}
    assert {tuple(r) for r in got.collect()} == want


def test_one_edit_is_case_sensitive_and_k_edits_lower_the_query(spark):
    terms = catalog(spark, ["free"])
    assert M.match_edit1(queries(spark, ["FREE"]), terms).first()["pos"] is None
    assert M.match_edit(queries(spark, ["FREE"]), terms).first()["pos"] == 0


def test_match_plan_has_no_nested_loop(spark):
    words = [f"w{i}" for i in range(50)]
    plan = M.match_edit1(queries(spark, words), catalog(spark, words))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


COMPANIES = ["Apple Inc.", "Microsoft Corporation", "Alphabet Inc. (Google)", "Amazon.com, Inc.",
             "Meta Platforms, Inc. (Facebook)", "Tesla, Inc."]


def test_suggestions_on_both_ways(spark):
    names = catalog(spark, COMPANIES + ["Zinc Works Inc."])
    asked = ["inc", "", "MICRO", "none", "inc."]
    want = {}
    for q in asked:
        want[q] = [i for i, n in enumerate(COMPANIES + ["Zinc Works Inc."]) if q.lower() in n.lower()][:5]
    for given in (asked, queries(spark, asked)):
        rows = M.suggest(given, names).collect()
        got = {q: sorted(r["pos"] for r in rows if r["query"] == q) for q in asked}
        assert got == want
    assert len(want["inc"]) == 5


def test_suggestions_without_usable_queries(spark):
    names = spark.createDataFrame([(0, "Acme"), (1, None)], "pos int, term string")
    for given in ([], [None], spark.createDataFrame([], "query string"), spark.createDataFrame([(None,)], "query string")):
        assert M.suggest(given, names).count() == 0
    assert [tuple(r) for r in M.suggest([None, "cm"], names).collect()] == [("cm", "Acme", 0)]
