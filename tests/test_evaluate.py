import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from webgrain.lookups import SCORE_NAMES
from webgrain.operators import evaluate as E
from webgrain.plans.scale import materialize


def table(spark, systems):
    """``{system: {metric: [scores]}}`` to a score table, systems in the given order."""
    rows = [
        (metric, system, i, None if s is None else float(s))
        for i, (system, metrics) in enumerate(systems.items())
        for metric, scores in metrics.items() for s in scores
    ]
    return spark.createDataFrame(rows, "metric string, system string, ord int, score double")


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def brute_p(a, b):
    """Exact one-sided p of untied samples by all arrangements."""
    pooled = sorted(a + b)
    u, hits, total = brute_u(a, b), 0, 0
    for chosen in itertools.combinations(range(len(pooled)), len(a)):
        rest = [i for i in range(len(pooled)) if i not in chosen]
        total += 1
        hits += sum(i > j for i in chosen for j in rest) >= u
    return hits / total


def test_exact_p_by_enumeration():
    rnd = random.Random(1)
    for n1, n2 in [(1, 1), (1, 6), (3, 3), (3, 5), (5, 3), (4, 7), (6, 6)]:
        pool = rnd.sample(range(100), n1 + n2)
        a, b = pool[:n1], pool[n1:]
        assert E.exact_p(int(brute_u(a, b)), n1, n2) == pytest.approx(brute_p(a, b), abs=1e-12)


def counted(m, n):
    """Arrangements per U by the classic recursion."""
    if m == 0 or n == 0:
        return [1]
    a, b = counted(m - 1, n), counted(m, n - 1)
    return [(a[u - n] if 0 <= u - n < len(a) else 0) + (b[u] if u < len(b) else 0)
            for u in range(m * n + 1)]


def test_exact_p_for_eight_against_many():
    for m, n in [(8, 9), (7, 12), (8, 30)]:
        ways = [1]
        # numbers of subsets by sum: add one value at a time
        table_ = [[0] * (m * n + 1) for _ in range(m + 1)]
        table_[0][0] = 1
        for rank in range(m + n):
            for size in range(min(m, rank + 1), 0, -1):
                shift = rank - (size - 1)  # smaller values that are not chosen, at most n
                for u in range(m * n, shift - 1, -1):
                    if table_[size - 1][u - shift]:
                        table_[size][u] += table_[size - 1][u - shift]
        ways = table_[m]
        assert sum(ways) == math.comb(m + n, m)
        for u in (0, 1, m * n // 3, m * n // 2, m * n - 2, m * n):
            assert E.exact_p(u, m, n) == pytest.approx(sum(ways[u:]) / sum(ways), abs=1e-12)
    assert E.exact_p(8 * 10**9, 8, 10**9) == pytest.approx(0.0, abs=1e-60)  # does not grow with n


def test_rank_test_against_brute_force(spark):
    rnd = random.Random(9)
    systems = {
        "x": {"m": [rnd.randint(0, 30) for _ in range(25)]},
        "y": {"m": [rnd.randint(0, 25) for _ in range(18)]},
        "z": {"m": [0.5 + i for i in range(5)]},
        "w": {"m": [100 + i for i in range(12)]},
        "same": {"m": [7] * 4},
        "same2": {"m": [7] * 9},
    }
    counts = materialize(E.histogram(table(spark, systems), ["metric", "system"], "score"))
    names = list(systems)
    pairs = spark.createDataFrame(
        [("m", a, b) for a in names for b in names if a != b], "metric string, a string, b string")
    for r in E.mann_whitney(counts, pairs).collect():
        a, b = systems[r["a"]]["m"], systems[r["b"]]["m"]
        assert r["u"] == brute_u(a, b) and (r["n1"], r["n2"]) == (len(a), len(b))
        pooled = a + b
        ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
        assert r["tie_sum"] == ties
        n = len(pooled)
        s = math.sqrt(len(a) * len(b) / 12 * (n + 1 - ties / (n * (n - 1))))
        if min(len(a), len(b)) <= 8 and ties == 0:
            if math.comb(n, len(a)) < 50_000:
                assert r["p_value"] == pytest.approx(brute_p(a, b))
        elif s == 0:
            assert r["p_value"] == 1.0 and r["z"] is None
        else:
            z = (brute_u(a, b) - len(a) * len(b) / 2 - 0.5) / s
            assert r["z"] == pytest.approx(z)
            assert r["p_value"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)))


def test_states_of_several_runs_add_up(spark):
    """Any split of the scores, also one that parts a system from its least place or its only NaN, gives
    the comparison of the whole; many systems make no larger plan."""
    rnd = random.Random(3)
    systems = {f"s{i}": {m: [rnd.choice([rnd.randint(0, 9) / 2, None, float("nan")]) for _ in range(rnd.randint(1, 20))]
                         for m in ("m1", "m2")} for i in range(40)}
    systems["empty"] = {"m1": [None], "m3": [float("nan")]}
    scores = table(spark, systems)
    want = sorted(map(repr, E.compare_groups(scores).collect()))
    assert len(want) == 3
    parts = [E.score_counts(scores.filter(F.pmod(F.xxhash64("system", "score"), F.lit(3)) == k)) for k in range(3)]
    merged = E.merge_counts(E.merge_counts(parts[2], parts[0]), parts[1])
    assert sorted(map(repr, E.compare_counts(merged).collect())) == want
    assert E.compare_counts(E.score_counts(scores.limit(0))).count() == 0


def test_a_pair_with_an_absent_system(spark):
    counts = materialize(E.histogram(table(spark, {"a": {"m": [1, 2]}, "b": {"m": [3]}}), ["metric", "system"], "score"))
    pairs = spark.createDataFrame(
        [("m", "a", "x"), ("m", "x", "a"), ("m", "x", "y"), ("z", "a", "b"), ("m", "a", "b"), ("m", "a", "b")], "metric string, a string, b string")
    got = {(r.metric, r.a, r.b): (r.u, r.n1, r.n2) for r in E.mann_whitney(counts, pairs).collect()}
    assert got == {("m", "a", "x"): (0, 2, 0), ("m", "x", "a"): (0, 0, 2), ("m", "a", "b"): (0, 2, 1)}


def test_medians(spark):
    rnd = random.Random(4)
    groups = {"hot": [rnd.randint(0, 50) / 4 for _ in range(301)], "even": [1, 2, 3, 10], "one": [5],
              "pair": [1, 2]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("one", float("nan"))]
    got = E.median_by_group(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    assert {r["g"]: r["median"] for r in got} == {g: statistics.median(v) for g, v in groups.items()}
    assert {r["g"]: r["n"] for r in got}["one"] == 1


@pytest.mark.parametrize("accuracy", [10, 100, 10000])
def test_medians_from_brackets(spark, accuracy):
    """Groups of all small sizes, a hot one with ties, one of null keys; coarse sketches too."""
    rnd = random.Random(accuracy)
    rows = [(f"g{n}", k, float(rnd.randint(0, n))) for n in range(1, 30) for k in range(n)]
    rows += [("hot", k, rnd.choice([7.0, rnd.gauss(0, 50)])) for k in range(5000)] + [(None, k, float(k)) for k in range(10)]
    rows += [("g1", 9, None), ("g2", 9, float("nan")), ("none", 9, None)]
    df = spark.createDataFrame(rows, "g string, k long, v double").repartition(7)
    want = {}
    for g, _, v in rows:
        if v is not None and v == v:
            want.setdefault(g, []).append(v)
    got = {r.g: (r.n, r.median) for r in E.median_by_group(df, ["g"], "v", accuracy=accuracy).collect()}
    assert got == {g: (len(v), statistics.median(v)) for g, v in want.items()}
    whole = E.median_by_group(df, [], "v", accuracy=accuracy).first()
    assert whole.median == statistics.median([x for v in want.values() for x in v])


def test_average_ranks(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (3, 1, 3, 2, 3)], "g string, v double")
    got = {r["v"]: r["avg_rank"] for r in E.average_ranks(df, ["g"], "v").collect()}
    assert got == {1.0: 1.0, 2.0: 2.0, 3.0: 4.0}


def verdicts(spark, systems, **options):
    return {r["metric"]: r for r in E.compare_groups(table(spark, systems), **options).collect()}


def test_comparison_texts(spark):
    high, low = [0.9 + i / 1000 for i in range(15)], [0.1 + i / 1000 for i in range(15)]
    nan = float("nan")
    systems = {
        "a": {"clear": high, "close": high, "short": high, "alone": [0.5, None], "nan": [nan], "none": [None]},
        "b": {"clear": low, "close": [h - 0.0001 for h in high], "short": [0.2, 0.3], "alone": [None, nan],
              "nan": [None], "none": [None]},
    }
    got = verdicts(spark, systems)
    assert set(got) == {"clear", "close", "short", "alone", "nan"}  # NaN counts as a number, None does not
    r = got["clear"]
    assert r["best_system"] == "a" and r["significantly_different"]
    assert r["notes"] == ("a median (0.907) is significantly higher than all other comparable systems "
                          "(p < 0.05).")
    assert r["details"][0]["pair"] == "a_vs_b"
    assert r["details"][0]["median_diff"] == pytest.approx(0.8)
    r = got["close"]
    assert not r["significantly_different"]
    assert r["notes"] == ("a has the highest median (0.907), but was not significantly higher than all "
                          "comparable systems (alpha=0.05). Check details.")
    r = got["short"]
    assert r["details"][0]["note"] == "Insufficient data (need >=3 samples per group, got 15 vs 2)"
    assert r["details"][0]["median_diff"] is None and not r["significantly_different"]
    r = got["alone"]
    assert r["notes"] == ("a has the highest median (0.500), but no other systems had valid data for "
                          "comparison on this metric.")
    assert r["details"] is None and not r["significantly_different"]
    r = got["nan"]
    assert r["best_system"] == "N/A" and r["notes"] == "No valid data found for any system for this metric."


def test_best_system_ties_go_to_the_first(spark):
    got = verdicts(spark, {"z": {"m": [1, 2, 3]}, "a": {"m": [2, 2, 2]}})
    assert got["m"]["best_system"] == "z"


def test_all_comparisons_must_be_significant(spark):
    up = [10 + i for i in range(12)]
    got = verdicts(spark, {"a": {"m": up}, "b": {"m": [i for i in range(12)]}, "c": {"m": up}})
    assert not got["m"]["significantly_different"] and len(got["m"]["details"]) == 2
    loose = verdicts(spark, {"a": {"m": up}, "b": {"m": [i for i in range(12)]}}, alpha=0.01)
    assert loose["m"]["significantly_different"]


def test_one_system_gives_nothing(spark):
    assert verdicts(spark, {"a": {"m": [1, 2, 3]}}) == {}


def test_pairwise_report(spark):
    scores = table(spark, {"a": {"m": [5, 6, 7, 8]}, "b": {"m": [1, 2, 3]}})
    r = E.pairwise_report(scores).first()
    assert (r["a"], r["b"], r["u"], r["significant"]) == ("a", "b", 12.0, True)
    assert r["p_value"] == pytest.approx(1 / math.comb(7, 3))


def test_metrics_long_keeps_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), 3)], "id int, a double, b int")
    rows = {r["metric"]: r["score"] for r in E.metrics_long(df, ["id"], ["a", "b"]).collect()}
    assert math.isnan(rows["a"]) and rows["b"] == 3.0


def test_lexical_scores(spark):
    df = spark.createDataFrame(
        [("what is it", ["A cat sat", "on it"], "the cat sat"), ("q", ["r"], ""), ("q", [], "x")],
        "q string, r array<string>, m string")
    rows = df.select(E.lexical_scores(F.col("q"), F.col("r"), F.col("m")).alias("s")).select("s.*").collect()
    assert rows[0]["faithfulness"] == pytest.approx(2 / 3)
    assert rows[0]["context_precision"] == pytest.approx(2 / 5)
    assert rows[0]["factual_correctness"] == pytest.approx(0.5)
    assert rows[1]["faithfulness"] is None and rows[2]["context_precision"] is None


def test_failing_items_stay(spark):
    def scorer(text):
        if text == "bad":
            raise ValueError("no good")
        return {"faithfulness": 0.5}

    df = spark.createDataFrame([("ok",), ("bad",)], "t string")
    rows = {r["t"]: r for r in E.score_items(df, scorer, ["t"]).collect()}
    assert rows["ok"]["faithfulness"] == 0.5 and rows["ok"]["error"] is None
    assert rows["bad"]["error"] == "no good" and rows["bad"]["faithfulness"] is None
    assert set(SCORE_NAMES) <= set(rows["ok"].asDict())


def test_an_evaluation_run_scores_once_and_keeps_failures(spark):
    from webgrain.plans.jobs import evaluation_run

    items = [(s, f"s{s}", i, f"q{i}", ["r"], "x" * (10 * s + i)) for s in (1, 2) for i in range(12)]
    items += [(1, "s1", 50, "", ["r"], "x"), (1, "s1", 51, "q", [], "x"), (1, "s1", 52, "q", ["r"], None), (2, "s2", 53, "bad", ["r"], "y"),
              (2, "s2", 54, "none", ["r"], "y"), (3, "s3", 1, "q", ["r"], "x")]
    df = spark.createDataFrame(items, "system_ord int, system_id string, item int, user_query string, reference array<string>, model_response string")
    config = spark.createDataFrame([("s1", "v1"), ("s2", None)], "system_id string, prompt_tag string")

    def scorer(query, reference, response):
        if query == "bad":
            raise ValueError("bad item")
        return {} if query == "none" else {"size": float(len(response))}

    run = evaluation_run(df, config, scorer, "T", ["size"])
    results = {r.item if r.system_id == "s1" else 100 + r.item: r for r in run.results.collect()}
    assert len(results) == 26 and not {50, 51, 52} & set(results)
    assert results[153].error == "bad item" and results[153]["size"] is None and results[154].error is None
    # incomplete items of s1 have used up 13, 14 and 15
    assert results[100].run_id == "run_T_16" and results[0].run_id == "run_T_1" and results[100].prompt_tag == "unknown"
    tracked = run.tracking.collect()
    assert len(tracked) == 24 and {r.metric_size for r in tracked} == {float(10 * s + i) for s in (1, 2) for i in range(12)}
    report = run.report.collect()
    assert [(r.metric, r.best_system, r.significantly_different, len(r.details)) for r in report] == [("size", "s2", True, 1)]
    alone = evaluation_run(df.filter("system_id = 's1'"), config, scorer, "T", ["size"])
    assert alone.report.count() == 0 and alone.results.count() == 12
