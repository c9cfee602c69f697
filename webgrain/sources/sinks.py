"""Writers: parquet appends, numbered snapshots, crawl items."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM_SCHEMA = "url string, title string, body string"


def write_items(df: DataFrame, path: str) -> None:
    df.select("url", "title", "body").write.mode("error").parquet(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEM_SCHEMA).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows; the first call creates the table. What is there is never rewritten."""
    df.write.mode("append").parquet(path)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def next_snapshot(spark: SparkSession, base: str) -> str:
    """``<base>_<n>`` for the first unused n from 1."""
    fs, hadoop_path = _filesystem(spark, base)
    n = 1
    while fs.exists(hadoop_path(f"{base}_{n}")):
        n += 1
    return f"{base}_{n}"


def write_snapshot(df: DataFrame, base: str) -> str:
    target = next_snapshot(df.sparkSession, base)
    df.write.mode("error").parquet(target)
    return target


def exclude_snapshots(files: DataFrame, base_name: str, suffix: str = ".zip") -> DataFrame:
    """Drop files named like earlier snapshots: ``<base>_`` at the start, the suffix at the end."""
    name = F.substring_index("path", "/", -1)
    return files.filter(~(name.startswith(f"{base_name}_") & name.endswith(suffix)))
