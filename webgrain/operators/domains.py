"""Registered domains by longest public suffix."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.functions.urls import netloc


def registered_domain(df: DataFrame, url: str, suffixes: DataFrame, name: str = "domain",
                      max_labels: int | None = None) -> DataFrame:
    """Add the longest public suffix plus one label; null for bad hosts and unknown suffixes.

    ``*.x`` makes every name below x a suffix; ``!a.x`` is an exception: a.x is then registered
    below x. One lookup per suffix length: each is an equi-join on the last labels of the host, so
    rows are never multiplied and nothing is grouped.
    """
    if max_labels is None:
        max_labels = suffixes.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 1
    full = F.when(F.col(url).rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:|^//"), F.col(url)).otherwise(
        F.concat(F.lit("https://"), F.col(url))
    )
    host = F.regexp_replace(F.regexp_replace(netloc(full), "^.*@", ""), r":\d*$", "")
    # hosts with blanks or underscores in the wrong place have no usable labels
    valid = F.when(host.rlike(r"^[^\s\[\]]+$") & ~host.rlike(r"^\d+(\.\d+){3}$"), host)
    out = df.withColumn("_host", valid)
    labels = F.size(F.split("_host", r"\."))
    # a wildcard is looked up by the labels behind it, an exception by its own
    rule = F.regexp_replace(F.lower("suffix"), r"^(\*\.|!)", "")
    known = suffixes.select(rule.alias("_suffix"), F.substring("suffix", 1, 1).alias("_c")).groupBy("_suffix").agg(
        F.bool_or(~F.col("_c").isin("*", "!")).alias("_plain"), F.bool_or(F.col("_c") == "*").alias("_any"),
        F.bool_or(F.col("_c") == "!").alias("_not"))
    for n in range(1, max_labels + 1):
        side = known.filter(F.size(F.split("_suffix", r"\.")) == n).select(
            F.col("_suffix").alias(f"_s{n}"), F.struct("_plain", "_any", "_not").alias(f"_r{n}"))
        tail = F.lower(F.substring_index("_host", ".", -n))
        out = out.join(side, (tail == F.col(f"_s{n}")) & (labels >= n), "left")
    rules = {n: F.col(f"_r{n}") for n in range(1, max_labels + 1)}
    longest = F.coalesce(
        *[F.when(rules[n]["_not"], F.lit(n - 1)) for n in range(max_labels, 0, -1)],
        *[F.when(on, F.lit(n)) for n in range(max_labels + 1, 0, -1) for on in [
            (rules[n]["_plain"] if n in rules else F.lit(False))
            | F.coalesce(rules[n - 1]["_any"] & (labels >= n) if n - 1 in rules else F.lit(False), F.lit(False))]],
    )
    domain = F.when(
        labels > longest,
        F.array_join(F.slice(F.split("_host", r"\."), -(longest + 1), longest + 1), "."),
    )
    return out.withColumn(name, domain).drop(
        "_host", *[f"_{c}{n}" for c in "sr" for n in range(1, max_labels + 1)])
