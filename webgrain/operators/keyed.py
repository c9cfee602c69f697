"""User functions applied per key."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_keyed(df: DataFrame, key: str, fn, value: str = "result") -> DataFrame:
    """(key, result text) of ``fn(key)`` for each distinct key, None results left out."""

    @F.arrow_udf("string")
    def run(keys: pa.Array) -> pa.Array:
        return pa.array([fn(k.as_py()) for k in keys], pa.string())

    return df.select(key).distinct().withColumn(value, run.asNondeterministic()(F.col(key))).filter(
        F.col(value).isNotNull()
    )
