"""Secret scans over an incremental ledger of blobs.

Every version of a document is addressed by the hash of its content. The ledger holds one row per
blob and rule version that was ever scanned, with the spans found (none is a finding too). A run
scans each unseen pair of blob and rule version once, appends it to the ledger, and joins the
findings back to all paths that carry the blob. Built-in functions only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain.llm.common import packed, unpacked


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates, leftmost and without overlap; those whose ``group`` has under
    ``min_length`` characters are dropped. ``probe`` may be a rarer pattern that every text with a
    finding holds. Give a rule a new ``version`` when any of these changes."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    min_length: int = 1
    probe: str = ""


# The base rules, in the order in which their findings are listed.
BASE_RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, "[0-9a-f]+", 0, 24, "[0-9a-f]{24}"),
)
# public forms of tokens and keys
MORE_RULES = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("hosting_token", 1, "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", 1, "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", 0, 1),
    Rule("chat_token", 1, "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:bigint,stop:bigint>>"
LEDGER = f"blob string, kind string, version int, spans {SPANS}"


def _running(values: Column, combine) -> Column:
    """Running totals of an array by an associative ``combine``: each round takes in the total that
    ends twice as far back, so n values cost n log n steps and no array grows by single items."""
    n = F.size(values)
    rounds = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda shift: shift < n)

    def step(a, shift):
        size = F.size(a)
        return F.concat(F.slice(a, 1, shift), F.zip_with(
            F.slice(a, shift + 1, size - shift), F.slice(a, 1, size - shift), combine))

    return F.aggregate(rounds, values, step)


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans (code points, end exclusive) of a rule's findings in a text.

    The text is cut at all candidates; the lengths of the pieces and candidates give the places, as
    running totals, so that a text of very many candidates stays cheap.
    """
    lengths = lambda a: F.transform(a, lambda x: F.length(x).cast("long"))

    def placed(p):
        # a candidate ends behind all pieces and candidates up to its own
        both = F.zip_with(F.slice(p["gap"], 1, F.size(p["hit"])), p["hit"], lambda g, h: g + h)
        return let(_running(both, lambda x, y: x + y), lambda stops: F.transform(F.filter(
            F.arrays_zip(stops.alias("stop"), p["hit"].alias("hit"), p["part"].alias("part")),
            lambda f: f["part"] >= rule.min_length),
            lambda f: F.struct((f["stop"] - f["hit"]).alias("start"), f["stop"].alias("stop"))))

    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    pieces = F.struct(
        lengths(F.split(text, rule.pattern, -1)).alias("gap"), lengths(hits).alias("hit"),
        lengths(parts).alias("part"))
    none = F.array().cast(SPANS)
    return F.when(text.rlike(rule.probe or rule.pattern), let(pieces, placed)).otherwise(none)


def _unseen(blobs: DataFrame, ledger: DataFrame, rules) -> DataFrame:
    """Blobs with the kinds (``_todo``) whose current version the ledger does not hold."""
    current = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    done = ledger.groupBy(F.col("blob").alias("_b")).agg(
        F.collect_set(F.concat_ws(":", "kind", "version")).alias("_done"))
    return (
        blobs.join(done, F.col("blob") == F.col("_b"), "left")
        .withColumn("_todo", F.array_except(current, F.coalesce("_done", F.array().cast("array<string>"))))
        .filter(F.size("_todo") > 0).drop("_b", "_done"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one is made where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def scan(docs: DataFrame, ledger_path: str, rules=RULES, text: str = "text") -> DataFrame:
    """The columns of ``docs`` (without the text) with ``blob`` and ``findings``: an array of
    (kind, start, stop) by start, then by the order of ``rules``.

    Null texts count as empty. Equal texts, however many, are one blob and scanned once; the same
    blob under several rows gets the same findings on each row. Empty tables give empty results.
    Columns of ``docs`` named blob or findings are replaced. A pair once in the ledger is not
    scanned again in later runs; a run that is lost before its ledger rows are committed is simply
    scanned again. Two runs that scan the same pair at once write equal rows, which are merged.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in (text, "blob", "findings")]
    rows = docs.select(packed(keep), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    rows = rows.withColumn("blob", F.sha2(F.col("_t").cast("binary"), 256))
    ledger = read_ledger(spark, ledger_path)
    blobs = rows.select("blob", "_t").groupBy("blob").agg(F.any_value("_t").alias("_t"))
    results = F.array(*[
        F.when(F.array_contains("_todo", f"{r.kind}:{r.version}"), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
            rule_spans(F.col("_t"), r).alias("spans"))) for r in rules])
    (_unseen(blobs, ledger, rules)
     .select("blob", F.inline(F.array_compact(results)))
     .write.mode("append").parquet(ledger_path))
    order = F.array(*[F.lit(r.kind) for r in rules])
    wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    found = (
        spark.read.schema(LEDGER).parquet(ledger_path)
        .filter((F.size("spans") > 0) & F.array_contains(wanted, F.concat_ws(":", "kind", "version")))
        .select(F.col("blob").alias("_b"), F.explode(F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.array_position(order, F.col("kind")).alias("rank"),
            F.col("kind").alias("kind"), s["stop"].alias("stop")))).alias("_f"))
        .groupBy("_b").agg(F.sort_array(F.collect_set("_f")).alias("_f")))
    return (
        rows.select("_row", "blob").join(found, F.col("blob") == F.col("_b"), "left")
        .select(*unpacked(keep), "blob", F.transform(
            F.coalesce("_f", F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>")),
            lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["stop"].alias("stop"))
        ).alias("findings")))


def listed(findings: Column, kinds=None) -> Column:
    """``kind:start:end`` joined by commas, of all findings or of some kinds."""
    if kinds:
        findings = F.filter(findings, lambda f: f["kind"].isin(list(kinds)))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")


_BLOCK = 512  # code points; only the work for a piece depends on it


def _replaced(text: Column, spans: Column, with_: str) -> Column:
    """``text`` with each run of overlapping spans (sorted by start) replaced. What is kept between is
    taken from blocks of the text, so that a piece costs its own length and not that of all before."""
    def built(p):
        def piece(start, stop):
            first = F.floor(start / _BLOCK).cast("int")
            last = F.floor(stop / _BLOCK).cast("int")
            near = F.array_join(F.slice(p["blocks"], first + 1, last - first + 1), "")
            return F.substring(near, (start - first * _BLOCK + 1).cast("int"), (stop - start).cast("int"))

        # a span that starts before an earlier one's end belongs to that one's run
        heads = F.filter(
            F.zip_with(p["starts"], F.concat(F.array(F.lit(0).cast("long")), p["ends"]),
                       lambda start, before: F.struct(before.alias("before"), start.alias("start"))),
            lambda f: f["start"] >= f["before"])
        rest = piece(F.element_at(p["ends"], -1), p["size"])
        return F.array_join(F.concat(F.transform(heads, lambda f: piece(f["before"], f["start"])), F.array(rest)), with_)

    stops = F.transform(spans, lambda f: f["stop"])
    parts = F.struct(
        F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % _BLOCK), F.lit(0)).alias("blocks"),
        F.transform(spans, lambda f: f["start"]).alias("starts"),
        _running(stops, lambda x, y: F.greatest(x, y)).alias("ends"), F.length(text).cast("long").alias("size"))
    return let(parts, built)


def mask(docs: DataFrame, ledger_path: str, rules=RULES, text: str = "text", length: str | None = None,
         with_: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of a finding in the text replaced; all other columns and rows as
    they are, but for the column named by ``length``, which follows a changed text. Overlapping
    spans are replaced as one. The findings come back through the blob, so rows need no key."""
    spark = docs.sparkSession
    scan(docs.select(text), ledger_path, rules, text)
    wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    found = (
        spark.read.schema(LEDGER).parquet(ledger_path)
        .filter((F.size("spans") > 0) & F.array_contains(wanted, F.concat_ws(":", "kind", "version")))
        .select(F.col("blob").alias("_b"), F.explode("spans").alias("_f"))
        .groupBy("_b").agg(F.sort_array(F.collect_set("_f")).alias("_f")))
    blob = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)
    rows = docs.select(packed(docs.columns), blob.alias("_blob"), F.col(text).alias("_t")).join(
        found, F.col("_blob") == F.col("_b"), "left")
    t = F.col("_t")
    out = rows.withColumn("_new", F.when(F.col("_f").isNull(), t).otherwise(
        _replaced(t, F.col("_f"), with_)))
    changed = {text: F.col("_new").alias(text)}
    if length:
        changed[length] = F.when(F.col("_f").isNull(), F.col("_row")[length]).otherwise(
            F.length("_new").cast(docs.schema[length].dataType)).alias(length)
    return out.select(*[changed.get(c, old) for c, old in zip(docs.columns, unpacked(docs.columns))])
