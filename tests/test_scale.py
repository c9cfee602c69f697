import random

import pytest
from pyspark.sql import functions as F

from webgrain.plans import scale


def hot_rows(n=4000):
    """Group ``h`` holds far more than a third of the rows."""
    rnd = random.Random(3)
    groups = ["h"] * 6 + ["a", "b", None, "c"]
    return [(rnd.choice(groups), i, rnd.randint(0, 9)) for i in range(n)]


def expected_totals(rows):
    seen, out = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        out[i] = (g, seen.get(g, 0))
        seen[g] = seen.get(g, 0) + v
    return out



def test_running_totals(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(7)
    # no adaptive merging of partitions, so that the hot group really is cut
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scale.running_totals(df, ["g"], ["i"], ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["i"]: (r["g"], r["v_before"]) for r in got} == expected_totals(rows)
    assert len(got) == len(rows)


def test_range_partitions_cut_the_hot_group(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(hot_rows(), "g string, i int, v int")
        parts = scale._sorted_parts(df, ["g"], ["i"], "t").filter("g = 'h'")
        assert parts.select("_part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_index_is_dense_and_ordered(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    got = scale.global_index(df, ["v"], "n", start=1).collect()
    assert sorted((r["v"], r["n"]) for r in got) == [(v, v + 1) for v in range(500)]


def test_top_n_beyond_the_group_limit(spark):
    df = spark.createDataFrame(hot_rows(6000), "g string, i int, v int")
    few = scale.top_n_per_key(df, ["g"], ["i"], 3)
    many = scale.top_n_per_key(df, ["g"], ["i"], 1500)
    ranked = df.toPandas().sort_values("i")
    for got, n in ((few, 3), (many, 1500)):
        want = ranked.groupby("g", dropna=False).head(n)
        assert sorted(r["i"] for r in got.collect()) == sorted(want["i"])
        assert got.columns == df.columns


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Cluster:
        master = "spark://host:7077"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = Cluster

    with pytest.raises(RuntimeError):
        scale.shared_dir(Session)


def test_materialize_keeps_rows_and_prunes_columns(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    stored = scale.materialize(df)
    assert stored.agg(F.sum("x")).first()[0] == 90
    assert "ReadSchema: struct<x:bigint>" in stored.select("x")._jdf.queryExecution().toString()


def test_local_table(spark):
    assert scale.local_table(spark, [(1, "a"), (2, None)], "k long, v string").collect() == [
        (1, "a"), (2, None)]
    assert scale.local_table(spark, [], "k int").count() == 0
