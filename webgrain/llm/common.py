"""Helpers shared by the operators: words, stored stages, wide hashes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrain.plans.scale import fresh_path as fresh
from webgrain.plans.scale import materialize as stored

__all__ = ["BLANKS", "documents", "fresh", "packed", "stored", "unpacked", "words"]

# space and the control characters from tab to carriage return; nothing else parts words
BLANKS = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text (null: none), unchanged and in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def packed(columns: list[str]) -> Column:
    """The given columns as one struct ``_row``, so that no name of theirs meets one of an operator."""
    return F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in columns]).alias("_row")


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col("_row")[c].alias(c) for c in columns]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")
