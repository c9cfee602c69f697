"""Joins, set operations and keyed aggregates. No hints: Spark broadcasts a side only when its
size is under the threshold, and adaptive execution splits skewed partitions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.functions.strings import is_denied


def left_join(a: DataFrame, b: DataFrame, on: str, null_safe: bool = True) -> DataFrame:
    """Left join on one key; with ``null_safe`` missing keys match each other."""
    if not null_safe:
        return a.join(b, on, "left")
    other = b.withColumnRenamed(on, "_key")
    return a.join(other, F.col(on).eqNullSafe(F.col("_key")), "left").drop("_key")


def concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; columns missing on one side are null."""
    return a.unionByName(b, allowMissingColumns=True)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both."""
    return a.intersect(b)


def count_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key, missing keys left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def last_per_key(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """Value with the highest ``seq`` per key, combined on the map side."""
    return df.groupBy(key).agg(F.max_by(value, seq).alias(value))


def trusted(hosts: Column, trust_list: list[str], min_hits: int) -> Column:
    """Whether enough different listed hosts are among the hits."""
    listed = F.array(*[F.lit(h) for h in trust_list])
    return F.size(F.array_intersect(hosts, listed)) >= min_hits


def fold_verdicts(sites: DataFrame, answers: DataFrame, site: str = "site",
                  answer: str = "answer") -> DataFrame:
    """A site is allowed unless one of its chunks was answered ``0``; sites without chunks are
    allowed."""
    folded = answers.groupBy(site).agg(F.bool_or(is_denied(F.col(answer))).alias("_denied"))
    return sites.join(folded, site, "left").select(
        site, (~F.coalesce("_denied", F.lit(False))).alias("allowed")
    )


def mirror_plan(src: DataFrame, dst: DataFrame, key: str = "path",
                mtime: str = "mtime") -> DataFrame:
    """What a mirror run would do per path: copy new or newer files, delete extras, skip the
    rest."""
    s = src.select(F.col(key), F.col(mtime).alias("_src"))
    d = dst.select(F.col(key), F.col(mtime).alias("_dst"))
    action = (
        F.when(F.col("_dst").isNull(), "copy")
        .when(F.col("_src").isNull(), "delete")
        .when(F.col("_src") > F.col("_dst"), "copy")
        .otherwise("skip")
    )
    return s.join(d, key, "full").select(key, action.alias("action"))
