"""Whole jobs built from the operators."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.functions import dom as D
from webgrain.functions.urls import hostname
from webgrain.lookups import DEPTH_LIMIT, DOMAIN_CAP, SCORE_NAMES
from webgrain.operators.crawl import shred
from webgrain.operators.enrich import enrich, first_article_title, pick_companies
from webgrain.operators.evaluate import compare_groups, metrics_long, score_items
from webgrain.operators.filters import filter_captures, filter_nonempty, flatten_metrics, frontier, prepare_items
from webgrain.operators.joins import count_by
from webgrain.operators.ordering import cap_per_key, latest_per_key, sample_exact
from webgrain.plans.scale import materialize
from webgrain.sources.readers import cut_ranges, read_bodies
from webgrain.sources.records import fetch_records
from webgrain.sources.sinks import append_table


def split_extract_aggregate(df: DataFrame, extract, keys: list[str], aggregates: list,
                            out: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Rows go through a map-only ``extract`` and are aggregated by ``keys``; partial sums are
    made before the only shuffle, so input needs no repartitioning by key first. With ``out``
    the result is also written there."""
    result = extract(df).groupBy(*keys).agg(*aggregates)
    if out is not None:
        writer = result.write.mode("error")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out)
        return result.sparkSession.read.schema(result.schema).parquet(out)
    return result


def site_page_counts(pages: DataFrame, suffix_domain) -> DataFrame:
    """Pages and characters of body text per host and registered domain, latest page per
    address (the url without query and fragment).

    Pages are parsed where they are read and only their body length goes on: the dedup shuffles
    narrow rows, never markup. A latest page without a body still replaces the ones before it
    and is dropped afterwards.
    """
    d = F.col("dom")
    lengths = shred(pages, tags=["body"]).select(
        "page_id", "url", F.regexp_replace("url", r"[?#].*$", "").alias("urlkey"),
        F.when(D.has_body(d), F.length(D.body_text(d))).alias("n_chars"),
    )
    latest = latest_per_key(lengths, "urlkey", "page_id", ["url"]).filter(
        F.col("n_chars").isNotNull())

    def extract(df):
        return suffix_domain(df.withColumn("host", hostname(F.col("url"))))

    return split_extract_aggregate(
        latest, extract, ["domain", "host"],
        [F.count("*").alias("n_pages"), F.sum("n_chars").alias("n_chars")],
    )


def capture_pages(captures: DataFrame, records: DataFrame | str, on: str = "filename", **where) -> DataFrame:
    """Capture index and archive files to clean text and metadata. The files are a table (``on``, ``payload``) or a
    folder, in which the captures' ``filename`` are sought (files of any length). A capture of a file that is
    absent from the table drops out; of one absent from the folder, and of a bad range, it gives an empty row.

    Latest capture per key first, then the exact filters, then the byte ranges of the files: only
    wanted records are decoded.
    """
    wanted = filter_captures(
        latest_per_key(captures, "urlkey", "timestamp", ["url", "filename", "offset"]))
    cut = fetch_records(wanted, records) if isinstance(records, str) else cut_ranges(wanted, records, on, **where)
    bodies = read_bodies(cut)
    dom = shred(bodies, tags=["title", "meta"])
    d = F.col("dom")
    return filter_nonempty(
        dom.select("urlkey", "url", "timestamp", D.page_text(d).alias("html_parsed"),
                   D.url_metadata(d, F.col("url")).alias("url_metadata")),
        "url_metadata",
    )


def company_enrichment(companies: DataFrame, done: DataFrame | None, hits: DataFrame, responses: DataFrame,
                       key: str = "Company", out: str | None = None, n: int | None = None, seed: int = 0,
                       **title_options) -> DataFrame:
    """(key, title, content) of the companies, appended to ``out`` if named: joined with what is done,
    titles from the search hits (``query``, ``rank``, ``url``) under the trust rule, texts from the
    stored responses. A company without a trusted hit has an empty title, one without a response
    no content. With ``n`` a sample of that many companies is worked on (an error, if there are fewer)."""
    picked = pick_companies(companies, done, key)
    if n is not None:
        picked = sample_exact(picked, key, n, seed)
    titles = first_article_title(hits, **title_options).select(F.col("query").alias(key), "title")
    named = picked.select(key).join(titles, key, "left").select(
        key, F.coalesce("title", F.lit("")).alias("title"))
    found = enrich(named, responses, key)
    if out is not None:
        append_table(found, out)
    return found


def crawl_report(pages: DataFrame, starts: DataFrame, add_domain, order: list, max_depth: int = DEPTH_LIMIT,
                 cap: int = DOMAIN_CAP, url: str = "url") -> DataFrame:
    """(domain, n): crawled pages per registered domain. Start urls give the domains; of their pages
    those above the depth limit are taken, at most ``cap`` per domain in the given order."""
    domains = add_domain(starts).select("domain").filter(F.col("domain").isNotNull()).distinct()
    near = frontier(add_domain(pages), url, domains, max_depth)
    return count_by(cap_per_key(near, "domain", order, cap), "domain")


@dataclass(frozen=True)
class EvaluationRun:
    """``results``: a row per complete item of a configured system, scored or failed (``error``).
    ``tracking``: the log of the scored ones, without those whose scores are all missing.
    ``report``: the verdict per metric (``compare_groups``)."""

    results: DataFrame
    tracking: DataFrame
    report: DataFrame


def evaluation_run(items: DataFrame, config: DataFrame, scorer, run_ts: str, metrics: list[str] = SCORE_NAMES,
                   inputs: tuple[str, ...] = ("user_query", "reference", "model_response"), alpha: float = 0.05,
                   min_n: int = 3) -> EvaluationRun:
    """Evaluate the items (system_ord, system_id, item, user_query, reference, model_response) of the
    systems in ``config`` (system_id, prompt_tag) by a Python scorer of one item.

    Items are numbered over all configured systems; incomplete ones use up a number. Every item is
    scored once and the results are stored; an item whose scorer fails keeps its row with the message,
    is not tracked, and counts as missing in the comparison.
    """
    scored = score_items(prepare_items(items, config, run_ts), scorer, list(inputs), list(metrics))
    results = materialize(scored.select(
        "run_id", "eval_count", "system_ord", "system_id", "prompt_tag", "item", "user_query", "model_response",
        *metrics, "error"), "evaluation")
    tracking = flatten_metrics(
        results.filter("error is null"), list(metrics), ["run_id", "system_id", "prompt_tag", "user_query", "model_response"])
    scores = metrics_long(results.select(
        F.col("system_id").alias("system"), F.col("system_ord").alias("ord"), *metrics), ["system", "ord"], list(metrics))
    return EvaluationRun(results, tracking, compare_groups(scores, alpha, min_n))
