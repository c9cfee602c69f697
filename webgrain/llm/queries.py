"""The named queries of this package and the SQL that must give the same rows."""

from functools import wraps

from pyspark.sql import functions as F

from webgrain.llm import common
from webgrain.session import ship

QUERIES = {}
ORACLE = {}


def query(sql=None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf):
            ship(spark)
            return fn(spark, sf)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


@query()
def op5_quality_rules(spark, sf):
    from webgrain.llm.quality import rate

    return rate(common.documents(spark, sf), columns=["doc_id"])


@query()
def op9_sharding(spark, sf):
    from webgrain.llm.sharding import shard

    return shard(common.documents(spark, sf).select("doc_id", "text"), shards=24)


@query()
def op10_secret_scans(spark, sf):
    from webgrain.llm.secrets import BASE_RULES, listed, scan

    docs = common.documents(spark, sf).select("doc_id", "text")
    found = F.col("findings")
    count = lambda kind: F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("long")
    return scan(docs, common.fresh(spark, "ledger")).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(found, [r.kind for r in BASE_RULES]).cast("binary"), 256).alias("base_sha256"),
        listed(found).alias("spans"))


@query()
def op8_sentencepiece(spark, sf):
    import public_tokenizers

    from webgrain.llm.pieces import digest

    docs = common.documents(spark, sf).select("doc_id", "text")
    return digest(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


@query()
def op4_html_extraction(spark, sf):
    from webgrain.llm.wrappers import extract

    return extract(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))


@query()
def op1_substring_dedup(spark, sf):
    from webgrain.llm.substrings import dedup_substrings

    return dedup_substrings(common.documents(spark, sf)).drop("kept_text")


@query()
def op6_suffix_dedup(spark, sf):
    from webgrain.llm.suffixes import dedup_bytes

    return dedup_bytes(common.documents(spark, sf)).drop("kept")


@query()
def op2_minhash_near_dedup(spark, sf):
    from webgrain.llm.neardup import near_duplicates

    return near_duplicates(common.documents(spark, sf), words=3, percent=85)


@query()
def op3_decontamination(spark, sf):
    from webgrain.llm.decontaminate import mark

    docs = common.documents(spark, sf).select("doc_id", "text")
    return mark(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
        F.transform("items", lambda x: x["item_id"]).alias("item_ids"),
        F.exists("items", lambda x: ~x["same"]).alias("other_values"))


@query()
def op7_lm_scoring(spark, sf):
    from webgrain.llm.classlm import score_held_out

    return score_held_out(common.documents(spark, sf))


@query()
def op11_license_scans(spark, sf):
    from webgrain.llm.licenses import labels, scan_licenses

    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    return scan_licenses(common.documents(spark, sf)).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        "score")


@query("""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h
  FROM documents
), c AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y, CASE
    WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
    WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b, substring(t, 1, least(x, y)) AS prefix,
    substring(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS middle, substring(t, greatest(x, y) + 1) AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
""")
def op12_fill_in_middle(spark, sf):
    from webgrain.llm.frames import digests, fill_in_middle

    return digests(fill_in_middle(common.documents(spark, sf)))


@query()
def op13_periodic_runs(spark, sf):
    from webgrain.llm.runs import collapse_runs, listed, planted, strongest

    best = F.col("_best")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return collapse_runs(planted(common.documents(spark, sf))).withColumn("_best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        sha(listed(F.col("runs"))).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
