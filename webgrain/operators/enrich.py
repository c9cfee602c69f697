"""Company enrichment over stored search hits and article responses."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain import lookups as L
from webgrain.functions.strings import json_first_extract
from webgrain.functions.urls import netloc, path, unquote
from webgrain.operators.joins import left_join


def first_article_title(
    hits: DataFrame, key: str = "query", rank: str = "rank", url: str = "url",
    host: str = L.ARTICLE_HOST, trust_list: list[str] = L.TRUSTED_HOSTS,
    min_hits: int = L.TRUSTED_MIN_HITS, prefix: str = L.ARTICLE_PREFIX,
) -> DataFrame:
    """(key, title): the path of the first hit on ``host`` without its prefix, decoded; empty
    when there is none or when fewer than ``min_hits`` different listed hosts were hit.

    The set of listed hosts seen is bounded by the list, so the aggregate buffer is small.
    """
    at = netloc(F.col(url))
    name = unquote(F.replace(path(F.col(url)), F.lit(prefix), F.lit("")))
    on_host = at == host
    return (
        hits.groupBy(key)
        .agg(
            F.min_by(name, F.when(on_host, F.col(rank))).alias("_title"),
            F.collect_set(F.when(at.isin(*set(trust_list)), at)).alias("_listed"),
        )
        .select(
            key,
            F.when(F.size("_listed") >= min_hits, F.coalesce("_title", F.lit("")))
            .otherwise(F.lit("")).alias("title"),
        )
    )


def pick_companies(companies: DataFrame, done: DataFrame | None, key: str = "Company") -> DataFrame:
    """Companies to work on: joined with what is there already (not excluded), key known."""
    merged = companies if done is None else left_join(companies, done, key)
    return merged.filter(F.col(key).isNotNull())


def enrich(titles: DataFrame, responses: DataFrame, key: str = "Company") -> DataFrame:
    """(key, title, content): titles joined with the text of their article responses
    (``title``, ``body``); a title without a response has null content."""
    content = responses.filter(F.col("title") != "").select(
        "title", json_first_extract(F.col("body")).alias("content")
    )
    return titles.select(key, "title").join(content, "title", "left").select(
        key, "title", "content"
    )
