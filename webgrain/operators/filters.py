"""Row filters and projections."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain import lookups as L
from webgrain.functions import urls
from webgrain.functions.strings import prompt
from webgrain.plans.scale import global_index


def filter_captures(
    df: DataFrame, status=L.CAPTURE_STATUS, mime=L.CAPTURE_MIME, language=L.CAPTURE_LANGUAGE,
    encoding=L.CAPTURE_ENCODING,
) -> DataFrame:
    """Exact matches on the capture fields; missing values fail."""
    return df.filter(
        (F.col("status") == status) & (F.col("mime") == mime)
        & (F.col("languages") == language) & (F.col("encoding") == encoding)
    )


def filter_nonempty(df: DataFrame, col: str) -> DataFrame:
    """Drop empty strings; missing values stay."""
    return df.filter(~F.col(col).eqNullSafe(""))


def filter_known(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def filter_required(df: DataFrame, texts: list[str], arrays: list[str] = ()) -> DataFrame:
    """Keep rows in which every text and every array is present and not empty."""
    tests = [F.coalesce(F.length(c) > 0, F.lit(False)) for c in texts]
    tests += [F.coalesce(F.size(c) > 0, F.lit(False)) for c in arrays]
    return df.filter(reduce(Column.__and__, tests))


def filter_configured(items: DataFrame, config: DataFrame, key: str = "system_id") -> DataFrame:
    return items.join(config.select(key), key, "left_semi")


def lookup_default(df: DataFrame, table: DataFrame, key: str, value: str, default) -> DataFrame:
    """Add ``value`` from a unique-key table, or the default where the key has no row there. A
    value that is present but null stays null."""
    return df.join(table.select(key, value, F.lit(True).alias("_known")), key, "left").withColumn(
        value, F.when(F.col("_known"), F.col(value)).otherwise(F.lit(default))
    ).drop("_known")


def frontier(df: DataFrame, url: str, domains: DataFrame, max_depth: int = L.DEPTH_LIMIT,
             key: str = "domain", patterns: list[str] | None = None) -> DataFrame:
    """Pages of the start domains that lie above the depth limit; optional word patterns."""
    near = df.filter(urls.depth(F.col(url)) < max_depth)
    if patterns:
        near = near.filter(reduce(Column.__or__, [F.contains(url, F.lit(p)) for p in patterns]))
    return near.join(domains.select(key), key, "left_semi")


def within_hours(ts: Column, start: Column, end: Column) -> Column:
    """``start <= hour < end`` without wrap at midnight; open when a bound is missing."""
    hour = F.hour(ts)
    bounded = start.isNotNull() & end.isNotNull()
    return F.when(bounded, (hour >= start) & (hour < end)).otherwise(F.lit(True))


def build_prompt(df: DataFrame, content: str, summary: str, name: str = "prompt") -> DataFrame:
    """Keep only the derived prompt."""
    return df.select(prompt(F.col(content), F.col(summary)).alias(name))


def flatten_metrics(df: DataFrame, metrics: list[str], ids: list[str],
                    prefix: str = "metric_") -> DataFrame:
    """Prefix the scores, cast to double, drop rows without any score. NaN counts as a value."""
    cast = [F.col(m).cast("double").alias(prefix + m) for m in metrics]
    return df.select(*ids, *cast).filter(F.coalesce(*[prefix + m for m in metrics]).isNotNull())


def stringify(df: DataFrame, order: list[str], show_index: bool = True) -> DataFrame:
    """Every cell as text, with a row number from 0 in the given order."""
    names = df.columns
    if show_index:
        df = global_index(df, order, "index")
        names = ["index", *names]
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])


def prepare_items(items: DataFrame, config: DataFrame, run_ts: str) -> DataFrame:
    """Evaluation items of configured systems, numbered and tagged.

    ``items``: system_ord, system_id, item, user_query, reference, model_response.
    The number runs over all configured systems; incomplete items use up a number and are then
    dropped.
    """
    tags = config.select("system_id", F.coalesce("prompt_tag", F.lit("unknown")).alias("prompt_tag"))
    tagged = items.join(tags, "system_id")
    numbered = global_index(tagged, ["system_ord", "item"], "eval_count", start=1)
    complete = filter_required(numbered, ["user_query", "model_response"], ["reference"])
    return complete.withColumn(
        "run_id", F.concat(F.lit(f"run_{run_ts}_"), F.col("eval_count").cast("string"))
    )
