"""Scoring and comparison of systems: medians and one-sided rank tests.

Raw scores are first counted per (metric, system, value). Medians and rank sums then come from
running totals over those counts (``plans.scale.running_totals``), so neither a metric nor a
system has to fit in one task.
"""

import math
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain import lookups as L
from webgrain.plans.scale import materialize, running_totals


def metrics_long(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """One row per (row, metric); NaN stays NaN here."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ids, metrics, "metric", "score"
    )


def histogram(df: DataFrame, by: list[str], value: str, n: str = "n") -> DataFrame:
    """Rows per value, missing and NaN values left out."""
    return df.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*by, value).agg(
        F.count("*").alias(n)
    )


def median_of_counts(counts: DataFrame, by: list[str], value: str, n: str = "n") -> DataFrame:
    """Exact median and count per group from a stored histogram (mean of the middle two)."""
    placed = running_totals(counts, by, [value], [n])
    totals = counts.groupBy(*by).agg(F.sum(n).alias("n_total"))
    first, after = F.col(f"{n}_before"), F.col(f"{n}_before") + F.col(n)

    def at(position):
        return F.max(F.when((first <= position) & (position < after), F.col(value)))

    lower, upper = F.floor((F.col("n_total") - 1) / 2), F.floor(F.col("n_total") / 2)
    return (
        placed.join(totals, by)
        .groupBy(*by)
        .agg(F.first("n_total").alias("n"), at(lower).alias("_lo"), at(upper).alias("_hi"))
        .select(*by, "n", ((F.col("_lo") + F.col("_hi")) / 2).alias("median"))
    )


def median_by_group(df: DataFrame, by: list[str], value: str, accuracy: int = 10000) -> DataFrame:
    """(by, n, median): exact median (mean of the middle two) and count per group, missing and NaN values
    left out.

    A quantile sketch per group brackets the middle to within a few rows in ``accuracy``; a second pass
    counts the rows below the bracket and those at each value inside, both combined on the map side. So
    nothing is sorted but the few values in the brackets, and a group may fill any number of partitions.
    A middle outside its bracket would fail the query.
    """
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).alias("_v"))
    around = [0.5 - 2 / accuracy, 0.5 + 2 / accuracy]
    bracket = rows.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(
        F.percentile_approx("_v", around, accuracy).alias("_q"), F.count("*").alias("n"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], F.lit(True))
    low, high = F.col("_q")[0], F.col("_q")[1]
    # all rows below the bracket count as one, in front of the values inside
    counts = rows.join(bracket, same).filter(F.col("_v") <= high).groupBy(*by, "n", F.when(
        F.col("_v") >= low, F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*by).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_first", F.coalesce(F.sum("_c").over(before), F.lit(0)))

    def at(position):
        return F.max(F.when((F.col("_first") <= position) & (position < F.col("_first") + F.col("_c")), F.col("_v")))

    middle = placed.groupBy(*by, "n").agg(
        at(F.floor((F.col("n") - 1) / 2)).alias("_lo"), at(F.floor(F.col("n") / 2)).alias("_hi"))
    outside = F.col("_lo").isNull() | F.col("_hi").isNull()
    return middle.select(*by, "n", F.when(outside, F.raise_error(F.lit("a middle lies outside its bracket"))).otherwise(
        (F.col("_lo") + F.col("_hi")) / 2).alias("median"))


def average_ranks(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n, avg_rank): rank of each distinct value, ties share the mean rank."""
    placed = running_totals(histogram(df, by, value), by, [value], ["n"])
    return placed.select(
        *by, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("avg_rank")
    )


# --- rank test ------------------------------------------------------------------------------


@lru_cache(maxsize=16)
def _part_sums(m: int):
    """Numerator of 1/((1-q)(1-q)(1-q^2)...(1-q^m)) over the common denominator
    (1-q^L)^(m+1), L = lcm(1..m)."""
    size = math.lcm(*range(1, m + 1))
    poly = [1]
    for part in [1, *range(1, m + 1)]:
        out = [0] * (len(poly) + size - part)
        for shift in range(0, size, part):
            for i, c in enumerate(poly):
                out[i + shift] += c
        poly = out
    return size, poly


def _partitions_upto(total: int, m: int) -> int:
    """Number of partitions of 0..total into at most m parts."""
    size, poly = _part_sums(m)
    return sum(
        poly[j] * math.comb((total - j) // size + m, m)
        for j in range(total % size, min(len(poly), total + 1), size)
    )


def exact_p(u: int, n1: int, n2: int) -> float:
    """P(U >= u) without ties. The arrangements with U <= c are partitions into at most m parts
    no larger than n; the size limit is taken off by inclusion and exclusion. The work depends
    on the smaller sample only, which is at most 8."""
    m, n = min(n1, n2), max(n1, n2)
    below = n1 * n2 - u
    if below < 0:
        return 0.0
    limits = {0: 1}
    for i in range(1, m + 1):
        for shift, sign in list(limits.items()):
            limits[shift + n + i] = limits.get(shift + n + i, 0) - sign
    ways = sum(
        sign * _partitions_upto(below - shift, m)
        for shift, sign in limits.items() if shift <= below
    )
    return float(min(1.0, ways / math.comb(m + n, m)))


def _p_value(u: Column, z: Column, n1: Column, n2: Column, tied: Column) -> Column:
    @F.pandas_udf("double")
    def p(u: pd.Series, z: pd.Series, n1: pd.Series, n2: pd.Series, tied: pd.Series) -> pd.Series:
        def one(u, z, a, b, t):
            if min(a, b) <= 8 and not t:
                return exact_p(int(u), int(a), int(b))
            return 1.0 if pd.isna(z) else 0.5 * math.erfc(z / math.sqrt(2))

        return pd.Series([one(*row) for row in zip(u, z, n1, n2, tied)], dtype=float)

    return p(u, z, n1, n2, tied)


def mann_whitney(counts: DataFrame, pairs: DataFrame, metric: str = "metric",
                 system: str = "system", value: str = "score", with_p: bool = True) -> DataFrame:
    """One-sided rank test (first greater) for each (metric, a, b) of ``pairs``.

    ``counts`` is the histogram per (metric, system, value). U adds, over the values of a, the
    number of smaller values of b and half of the equal ones. z has the tie and continuity
    corrections and is null when all values are equal (p = 1). p is exact when a sample has at
    most 8 values and nothing is tied.

    Systems are rows: a running total over the counts of each first system, taken at the values of
    the systems it meets, serves all its pairs, so the plan is the same for two systems and for a
    million, and neither a system nor a pair has to fit in one task.
    """
    asked = pairs.select(metric, "a", "b").distinct()
    n = F.col("n")
    first = asked.select(metric, "a").distinct().join(
        counts.select(metric, F.col(system).alias("a"), value, n), [metric, "a"])
    second = asked.join(counts.select(metric, F.col(system).alias("b"), value, n), [metric, "b"])
    places = first.unionByName(second.select(metric, "a", value, F.lit(0).cast("long").alias("n"))).groupBy(
        metric, "a", value).agg(F.sum("n").alias("n_a"))
    placed = running_totals(places, [metric, "a"], [value], ["n_a"])

    def ties(count):
        return count.cast("double") * count * count - count

    n_a, n_b = F.col("n_a"), F.col("n")
    own = placed.groupBy(metric, "a").agg(F.sum("n_a").alias("_n1"), F.sum(ties(n_a)).alias("_ties"))
    met = second.join(placed, [metric, "a", value]).groupBy(metric, "a", "b").agg(
        F.sum(n_b * (F.col("n_a_before") + n_a / 2)).alias("_below"), F.sum(n_b).alias("_n2"),
        F.sum(ties(n_a + n_b) - ties(n_a)).alias("_more"))
    sums = asked.join(own, [metric, "a"], "left").join(met, [metric, "a", "b"], "left").select(
        metric, "a", "b", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("_n1", "_n2", "_below", "_ties", "_more")])
    stats = sums.select(
        metric, "a", "b", (F.col("_n1").cast("double") * F.col("_n2") - F.col("_below")).alias("u"),
        F.col("_n1").alias("n1"), F.col("_n2").alias("n2"), (F.col("_ties") + F.col("_more")).alias("tie_sum"),
    ).filter("n1 + n2 > 0")
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("tie_sum"), n * (n - 1))))
    z = F.try_divide(F.col("u") - n1 * n2 / 2 - 0.5, spread)
    out = stats.withColumn("z", z)
    if not with_p:
        return out
    tied = F.col("tie_sum") > 0
    return out.withColumn(
        "p_value",
        _p_value(F.col("u"), F.col("z"), F.col("n1"), F.col("n2"), tied),
    )


# --- comparison -----------------------------------------------------------------------------


def best_system(medians: DataFrame, metric="metric", system="system") -> DataFrame:
    """(metric, a, best_median): highest median, first system on ties. ``medians`` carries
    ``ord``, the input order of the systems."""
    rank = F.struct(F.col("median"), -F.col("ord"))
    return medians.groupBy(metric).agg(
        F.max_by(system, rank).alias("a"), F.max("median").alias("best_median")
    )


STATE = "metric string, system string, score double, n bigint, ord bigint"


def score_counts(scores: DataFrame) -> DataFrame:
    """The state of a comparison: rows per (metric, system, score) with their number ``n`` and the least
    ``ord``. Missing scores (null) and NaN are kept as values of their own, so a system without any number
    is still known. States of several runs add up (``merge_counts``)."""
    return scores.groupBy("metric", "system", F.col("score").cast("double").alias("score")).agg(
        F.count("*").alias("n"), F.min(F.col("ord").cast("long")).alias("ord"))


def merge_counts(*states: DataFrame) -> DataFrame:
    """One state of several: what is counted once is never read again."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("metric", "system", "score").agg(F.sum("n").alias("n"), F.min("ord").alias("ord"))


def _compared(state: DataFrame, alpha: float, min_n: int):
    state = materialize(state, "counts")
    counts = state.filter(F.col("score").isNotNull() & ~F.isnan("score")).select("metric", "system", "score", "n")
    systems = state.groupBy("system").agg(F.min("ord").alias("ord"))
    listed = state.filter(F.col("score").isNotNull()).select("metric").distinct()
    medians = materialize(
        median_of_counts(counts.filter(F.col("system").isNotNull()), ["metric", "system"], "score")
        .join(systems, "system"), "medians")
    best = best_system(medians)
    others = medians.select("metric", F.col("system").alias("b"), F.col("ord").alias("b_ord"),
                            F.col("median").alias("b_median"), F.col("n").alias("b_n"))
    own = medians.select("metric", F.col("system").alias("a"), F.col("n").alias("a_n"))
    pairs = (
        best.join(own, ["metric", "a"]).join(others, "metric").filter("a <> b")
        .withColumn("enough", (F.col("a_n") >= min_n) & (F.col("b_n") >= min_n))
    )
    tests = mann_whitney(counts, pairs.filter("enough")).select(
        "metric", "a", "b", "u", "z", "p_value")
    report = pairs.join(tests, ["metric", "a", "b"], "left").select(
        "metric", "a", "b", "b_ord", "u", "z", "p_value",
        F.when(F.col("enough"), F.col("best_median") - F.col("b_median")).alias("median_diff"),
        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("significant"),
        F.when(
            ~F.col("enough"),
            F.format_string(L.TOO_FEW, F.lit(min_n), "a_n", "b_n"),
        ).alias("note"),
    )
    return listed, systems, best, report


def pairwise_report(scores: DataFrame, alpha: float = 0.05, min_n: int = 3) -> DataFrame:
    """Best system against each other system with data, per metric."""
    return _compared(score_counts(scores), alpha, min_n)[3].drop("b_ord")


def compare_groups(scores: DataFrame, alpha: float = 0.05, min_n: int = 3) -> DataFrame:
    """Verdict per metric. ``scores``: metric, system, ord (input order of the system), score.

    A system counts when it has rows; with fewer than two the result is empty. A metric is
    listed when any score is a number, NaN included. ``details`` has one entry per compared
    system, so it is as long as the list of systems.
    """
    return compare_counts(score_counts(scores), alpha, min_n)


def compare_counts(state: DataFrame, alpha: float = 0.05, min_n: int = 3) -> DataFrame:
    """``compare_groups`` from a state (``score_counts``, ``merge_counts``)."""
    metrics, systems, best, report = _compared(state, alpha, min_n)
    enough_systems = systems.agg(F.count("*") >= 2)
    entry = F.struct("b_ord", F.concat("a", F.lit("_vs_"), "b").alias("pair"), "median_diff",
                     "p_value", "significant", "note")
    folded = report.groupBy("metric").agg(
        F.bool_and("significant").alias("all_significant"),
        F.sort_array(F.collect_list(entry)).alias("details"),
    )
    fields = ("a", "best_median")
    level = F.lit(str(alpha))
    notes = (
        F.when(F.col("a").isNull(), F.lit(L.NO_DATA))
        .when(F.col("all_significant").isNull(), F.format_string(L.NO_OTHERS, *fields))
        .when(F.col("all_significant"), F.format_string(L.HIGHER, *fields, level))
        .otherwise(F.format_string(L.NOT_HIGHER, *fields, level))
    )
    return (
        metrics.filter(enough_systems.scalar())
        .join(best, "metric", "left").join(folded, "metric", "left")
        .select(
            "metric",
            F.coalesce("a", F.lit("N/A")).alias("best_system"),
            F.coalesce("all_significant", F.lit(False)).alias("significantly_different"),
            notes.alias("notes"),
            "details",
        )
    )


# --- scoring --------------------------------------------------------------------------------


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def lexical_scores(query: Column, reference: Column, response: Column) -> Column:
    """Deterministic word-overlap scores under the five score names; null without words."""
    words = F.struct(
        _words(query).alias("q"), _words(F.array_join(reference, "\n")).alias("ref"),
        _words(response).alias("res"))
    return let(words, lambda w: _overlap(w["q"], w["ref"], w["res"]))


def _overlap(q, ref, res):
    shared = F.size(F.array_intersect(res, ref))

    def share(part, whole):
        return F.try_divide(part.cast("double"), F.size(whole).cast("double"))

    precision, recall = share(shared, res), share(shared, ref)
    grounded = share(F.size(F.array_intersect(res, F.array_union(ref, q))), res)
    f1 = F.when(shared == 0, F.lit(0.0)).otherwise(
        2 * precision * recall / (precision + recall))
    critic = share(F.size(F.array_intersect(q, res)), q)
    values = [precision, recall, grounded, F.when(precision.isNotNull() & recall.isNotNull(), f1),
              critic]
    return F.struct(*[v.alias(n) for v, n in zip(values, L.SCORE_NAMES)])


def score_items(df: DataFrame, scorer, inputs: list[str], names: list[str] = L.SCORE_NAMES) -> DataFrame:
    """Add scores from a Python function of one item; a failing item keeps its row with null
    scores and the message in ``error``."""
    fields = ",".join(f"{n}:double" for n in names)

    @F.pandas_udf(f"struct<{fields},error:string>")
    def run(*columns: pd.Series) -> pd.DataFrame:
        rows = []
        for item in zip(*columns):
            try:
                scores = scorer(*item)
                rows.append({n: scores.get(n) for n in names} | {"error": None})
            except Exception as e:  # noqa: BLE001 - any failure becomes data
                rows.append({n: None for n in names} | {"error": str(e)})
        return pd.DataFrame(rows, columns=[*names, "error"]).astype({n: float for n in names})

    return df.withColumn("_s", run.asNondeterministic()(*inputs)).select("*", "_s.*").drop("_s")


