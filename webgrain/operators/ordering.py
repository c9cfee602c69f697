"""Latest rows, caps, numbering, chunks, samples and shuffles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.lookups import DOMAIN_CAP
from webgrain.plans.scale import global_index, top_n_per_key


def latest_per_key(df: DataFrame, key: str, order: str, tiebreak: list[str]) -> DataFrame:
    """Last row per key (a missing key is a key too; a missing order value comes last). Apply before any filter on the rows: a key
    whose latest row fails the filter must vanish."""
    return top_n_per_key(
        df, [key], [F.desc_nulls_first(order), *[F.desc_nulls_last(c) for c in tiebreak]], 1)


def cap_per_key(df: DataFrame, key: str, order: list, n: int = DOMAIN_CAP) -> DataFrame:
    return top_n_per_key(df, [key], order, n)


def chunk_id(df: DataFrame, order: list[str], n: int, name: str = "chunk") -> DataFrame:
    """Consecutive chunks of n rows in the given order."""
    numbered = global_index(df, order, "_index")
    return numbered.withColumn(name, F.floor(F.col("_index") / n)).drop("_index")


def _seeded(df, key, seed):
    return df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows without replacement, repeatable for a seed; fails if there are fewer."""
    if df.select(key).count() < n:
        raise ValueError(f"sample of {n} rows asked from a smaller table")
    return _seeded(df, key, seed).orderBy("_h", key).limit(n).drop("_h")


def shuffle(df: DataFrame, key: str, seed: int = 0, name: str = "rank") -> DataFrame:
    """Random but repeatable position from 1 for every row."""
    return global_index(_seeded(df, key, seed), ["_h", key], name, start=1).drop("_h")


