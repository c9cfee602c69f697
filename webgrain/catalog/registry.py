"""Named queries with the SQL that must give the same rows."""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from webgrain.session import ship

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
