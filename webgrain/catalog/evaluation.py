"""Medians, rank tests and scores."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.catalog.rows import dialogue_items
from webgrain.lookups import SCORE_NAMES
from webgrain.operators import evaluate as E
from webgrain.plans.jobs import evaluation_run
from webgrain.plans.scale import local_table

ORDER = ["view", "click", "purchase", "error", "signup"]
LONG_CTE = """
with raw as (select event_id, event_type as system, value, cast(json_extract_string(props, '$.k') as double) as k
  from events),
l as (select event_id, system, 'value' as metric, value as score from raw
  union all select event_id, system, 'k', k from raw)
"""


def scores(spark, sf):
    """Two metrics per event, the event type as system."""
    wide = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("system"), "value",
        F.get_json_object("props", "$.k").alias("k"))
    order = F.array(*[F.lit(s) for s in ORDER])
    return E.metrics_long(wide, ["event_id", "system"], ["value", "k"]).withColumn(
        "ord", F.array_position(order, F.col("system")))


@query(LONG_CTE + "select * from l")
def metrics_long(spark, sf):
    return scores(spark, sf).drop("ord")


@query("select event_type, count(*) as n, round(median(value), 6) as median from events group by 1")
def median_by_group(spark, sf):
    out = E.median_by_group(table(spark, sf, "events"), ["event_type"], "value")
    return out.withColumn("median", F.round("median", 6))


@query(LONG_CTE + """
, m as (select metric, system, median(score) as med, list_position(['view', 'click', 'purchase', 'error',
    'signup'], system) as ord from l group by 1, 2)
select metric, system as best, round(med, 6) as median from m
qualify row_number() over (partition by metric order by med desc, ord) = 1
""")
def best_group(spark, sf):
    long = scores(spark, sf)
    counts = E.materialize(E.histogram(long, ["metric", "system"], "score"), "counts")
    order = long.groupBy("system").agg(F.min("ord").alias("ord"))
    medians = E.median_of_counts(counts, ["metric", "system"], "score").join(order, "system")
    return E.best_system(medians).select(
        "metric", F.col("a").alias("best"), F.round("best_median", 6).alias("median"))


@query("""
with c as (select event_type, value, count(*) as n from events group by 1, 2)
select event_type, value, n,
  coalesce(sum(n) over (partition by event_type order by value rows between unbounded preceding and 1 preceding), 0)
    + (n + 1) / 2 as avg_rank from c
""")
def avg_rank(spark, sf):
    return E.average_ranks(table(spark, sf, "events"), ["event_type"], "value")


def rank_sql(pairs, long=LONG_CTE):
    """Rank test in SQL over a ``pairs(metric, a, b)`` table expression."""
    return long + f"""
, pairs as ({pairs}),
pooled as (select p.metric, a, b, score, sum((system = a)::int) as n_a, sum((system = b)::int) as n_b
  from pairs p join l on l.metric = p.metric and (system = a or system = b) group by all),
r as (select *, coalesce(sum(n_b) over (partition by metric, a, b order by score
    rows between unbounded preceding and 1 preceding), 0) as below, n_a + n_b as t from pooled),
s as (select metric, a, b, sum(n_a * (below + n_b / 2)) as u, cast(sum(n_a) as double) as n1,
    cast(sum(n_b) as double) as n2, sum(cast(t as double) * t * t - t) as tie_sum from r group by 1, 2, 3),
z as (select *, (u - n1 * n2 / 2 - 0.5)
    / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - tie_sum / ((n1 + n2) * (n1 + n2 - 1)))) as z from s)
"""


ALL_PAIRS = """select m.metric, x.system as a, y.system as b from (values ('value'), ('k')) m(metric),
  (select distinct system from raw) x, (select distinct system from raw) y where x.system <> y.system"""


@query(rank_sql(ALL_PAIRS) + """
select metric, a, b, u, cast(n1 as bigint) as n1, cast(n2 as bigint) as n2, tie_sum, round(z, 6) as z,
  z > 1.6448536 as greater from z
""")
def mann_whitney(spark, sf):
    counts = E.materialize(E.histogram(scores(spark, sf), ["metric", "system"], "score"), "counts")
    systems = counts.select("metric", "system").distinct()
    pairs = (
        systems.withColumnRenamed("system", "a")
        .join(systems.withColumnRenamed("system", "b"), "metric").filter("a <> b")
    )
    return E.mann_whitney(counts, pairs).select(
        "metric", "a", "b", "u", "n1", "n2", "tie_sum", F.round("z", 6).alias("z"),
        (F.col("p_value") < 0.05).alias("greater"))


BEST_PAIRS = """
with m as (select metric, system, median(score) as med, list_position(['view', 'click', 'purchase', 'error',
    'signup'], system) as ord from l group by 1, 2),
best as (select * from m qualify row_number() over (partition by metric order by med desc, ord) = 1)
select m.metric, best.system as a, m.system as b, best.med - m.med as diff from m join best using (metric)
where m.system <> best.system"""


@query(rank_sql(BEST_PAIRS) + """
select z.metric, z.a, z.b, u, round(z, 6) as z, round(diff, 6) as median_diff, z > 1.6448536 as significant
from z join pairs p on p.metric = z.metric and p.b = z.b
""")
def pairwise_report(spark, sf):
    return E.pairwise_report(scores(spark, sf)).select(
        "metric", "a", "b", "u", F.round("z", 6).alias("z"),
        F.round("median_diff", 6).alias("median_diff"), "significant")


VERDICTS = """
, v as (select metric, a, bool_and(z > 1.6448536) as significant, count(*) as n_details from z group by 1, 2),
h as (select metric, median(score) as med from l join v using (metric) where system = a group by 1)
select metric, a as best_system, significant as significantly_different, case when significant
  then printf('%s median (%.3f) is significantly higher than all other comparable systems (p < 0.05).', a, med)
  else printf('%s has the highest median (%.3f), but was not significantly higher than all comparable systems (alpha=0.05). Check details.', a, med)
  end as notes, cast(n_details as int) as n_details
from v join h using (metric)
"""


@query(rank_sql(BEST_PAIRS) + VERDICTS)
def compare_groups(spark, sf):
    return E.compare_groups(scores(spark, sf)).select(
        "metric", "best_system", "significantly_different", "notes",
        F.size("details").alias("n_details"))


@query(rank_sql(BEST_PAIRS) + VERDICTS)
def compare_merged(spark, sf):
    """The comparison from two states, one of the events up to the middle and one of the rest."""
    long = scores(spark, sf)
    middle = table(spark, sf, "events").agg(F.floor(F.avg("event_id"))).scalar()
    halves = [E.score_counts(long.filter(c)) for c in (F.col("event_id") <= middle, F.col("event_id") > middle)]
    return E.compare_counts(E.merge_counts(*halves)).select(
        "metric", "best_system", "significantly_different", "notes", F.size("details").alias("n_details"))


BRANCH_CTE = """
with raw as (select event_type as system, value, row_number() over (partition by event_type order by event_id) as place
  from events),
l as (select system, 'value' as metric, value as score from raw
  union all select system, 'few', value from raw where system = 'view' or place = 1
  union all select system, 'alone', value from raw where system = 'view')
"""


@query(rank_sql(BEST_PAIRS, BRANCH_CTE) + """
, n as (select metric, system, count(*) as n, median(score) as med from l group by 1, 2),
d as (select p.metric, p.a, p.b, diff, x.n as na, y.n as nb, x.med as med, x.n >= 3 and y.n >= 3 as enough, z
  from pairs p join n x on x.metric = p.metric and x.system = p.a join n y on y.metric = p.metric and y.system = p.b
  left join z on z.metric = p.metric and z.b = p.b),
e as (select *, coalesce(enough and z > 1.6448536, false) as significant from d),
v as (select metric, bool_and(significant) as all_significant from e group by 1)
select metric, a as best_system, a || '_vs_' || b as pair, if(enough, round(diff, 6), null) as median_diff, significant,
  if(enough, null, printf('Insufficient data (need >=3 samples per group, got %d vs %d)', na, nb)) as note,
  if(all_significant, printf('%s median (%.3f) is significantly higher than all other comparable systems (p < 0.05).', a, med),
    printf('%s has the highest median (%.3f), but was not significantly higher than all comparable systems (alpha=0.05). Check details.', a, med)) as notes
from e join v using (metric)
union all select 'alone', 'view', null, null, null, null,
  printf('%s has the highest median (%.3f), but no other systems had valid data for comparison on this metric.', 'view', median(score))
  from l where metric = 'alone'
union all select 'nan', 'N/A', null, null, null, null, 'No valid data found for any system for this metric.'
""")
def comparison_details(spark, sf):
    """All entries of the details, also of metrics with too few scores, with one system, without a number."""
    events = table(spark, sf, "events").withColumnRenamed("event_type", "system")
    first = events.groupBy("system").agg(F.min("event_id").alias("first"))
    view = F.when(F.col("system") == "view", F.col("value"))
    wide = events.join(first, "system").select(
        "system", "value", F.coalesce(view, F.when(F.col("event_id") == F.col("first"), F.col("value"))).alias("few"),
        view.alias("alone"), F.lit(float("nan")).alias("nan"))
    order = F.array(*[F.lit(s) for s in ORDER])
    long = E.metrics_long(wide, ["system"], ["value", "few", "alone", "nan"]).withColumn(
        "ord", F.array_position(order, F.col("system")))
    return E.compare_groups(long).select("metric", "best_system", "notes", F.inline_outer("details")).select(
        "metric", "best_system", "pair", F.round("median_diff", 6).alias("median_diff"), "significant", "note", "notes")


WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))"


@query(f"""
with i as (select u.conv_id, u.turn, {WORDS.format('u.text')} as q, {WORDS.format('a.text')} as r,
    {WORDS.format("coalesce(s.text, '')")} as f
  from conversations u left join conversations a
    on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
  left join conversations s on s.conv_id = u.conv_id and s.role = 'system' where u.role = 'user'),
n as (select *, len(list_intersect(r, f)) as shared from i),
p as (select *, shared / nullif(len(r), 0) as prec, shared / nullif(len(f), 0) as rec from n)
select conv_id, turn, round(prec, 6) as faithfulness, round(rec, 6) as context_precision,
  round(len(list_intersect(r, list_distinct(list_concat(f, q)))) / nullif(len(r), 0), 6) as groundedness,
  round(case when prec is null or rec is null then null when shared = 0 then 0 else 2 * prec * rec / (prec + rec) end, 6)
    as factual_correctness,
  round(case when r is null then null else len(list_intersect(q, r)) / nullif(len(q), 0) end, 6) as instruction_critic
from p
""")
def lexical_scores(spark, sf):
    scored = dialogue_items(spark, sf).select("conv_id", "turn", E.lexical_scores(
        F.col("user_query"), F.col("reference"), F.col("model_response")).alias("s"))
    return scored.select(
        "conv_id", "turn", *[F.round(f"s.{n}", 6).alias(n) for n in SCORE_NAMES])


@query("""
select doc_id, case when lang = 'de' then null else n_chars / 1000 end as faithfulness,
  case when lang = 'de' then 'no scorer for de' end as error from documents
""")
def score_with_errors(spark, sf):
    def scorer(lang, n_chars):
        if lang == "de":
            raise ValueError(f"no scorer for {lang}")
        return {"faithfulness": n_chars / 1000}

    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return E.score_items(rows, scorer, ["lang", "n_chars"], ["faithfulness"]).select(
        "doc_id", "faithfulness", "error")


RUN = "20240101000000"
RUN_CTE = """
with i as (select u.conv_id % 5 as system_ord, 'sys' || (u.conv_id % 5) as system_id, u.conv_id * 10000 + u.turn as item,
    u.text as q, a.text as r, s.text as f
  from conversations u left join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
  left join conversations s on s.conv_id = u.conv_id and s.role = 'system' where u.role = 'user' and u.conv_id % 5 < 4),
n as (select *, row_number() over (order by system_ord, item) as eval_count from i),
d as (select *, 'run_20240101000000_' || eval_count as run_id,
    case system_id when 'sys0' then 'v1' when 'sys2' then 'v2' when 'sys3' then 'v3' else 'unknown' end as prompt_tag,
    length(q) % 7 = 0 as failed from n where q <> '' and r <> '' and f is not null)
"""
RUN_LONG = RUN_CTE + """
, l as (select system_id as system, 'faithfulness' as metric, length(r) / 1000 as score from d where not failed
  union all select system_id, 'groundedness', length(q) / 100 from d where not failed and length(q) % 2 = 0)
"""
RUN_PAIRS = """
with m as (select metric, system, median(score) as med from l group by 1, 2),
best as (select * from m qualify row_number() over (partition by metric order by med desc, system) = 1)
select m.metric, best.system as a, m.system as b, best.med - m.med as diff from m join best using (metric)
where m.system <> best.system"""


def dialogue_run(spark, sf):
    """Conversations dealt to five systems, of which four are configured and one has no tag. Questions
    whose length is a multiple of seven fail, and those of odd length have no second score."""

    def scorer(query, reference, response):
        if len(query) % 7 == 0:
            raise ValueError(f"{len(query)} characters")
        return {"faithfulness": len(response) / 1000, "groundedness": None if len(query) % 2 else len(query) / 100}

    system = F.col("conv_id") % 5
    items = dialogue_items(spark, sf).select(
        system.alias("system_ord"), F.concat(F.lit("sys"), system.cast("string")).alias("system_id"),
        (F.col("conv_id") * 10000 + F.col("turn")).alias("item"), "user_query", "reference", "model_response")
    config = local_table(
        spark, [("sys0", "v1"), ("sys1", None), ("sys2", "v2"), ("sys3", "v3")], "system_id string, prompt_tag string")
    return evaluation_run(items, config, scorer, RUN, ["faithfulness", "groundedness"])


@query(RUN_CTE + """
select run_id, system_id, prompt_tag, item, not failed as scored,
  if(failed, length(q) || ' characters', null) as error from d
""")
def evaluation_results(spark, sf):
    return dialogue_run(spark, sf).results.select(
        "run_id", "system_id", "prompt_tag", "item", F.col("faithfulness").isNotNull().alias("scored"), "error")


@query(RUN_CTE + """
select run_id, system_id, prompt_tag, md5(q) as user_query, md5(r) as model_response, length(r) / 1000 as metric_faithfulness,
  if(length(q) % 2 = 0, length(q) / 100, null) as metric_groundedness from d where not failed
""")
def evaluation_tracking(spark, sf):
    tracked = dialogue_run(spark, sf).tracking
    return tracked.withColumns({c: F.md5(c) for c in ("user_query", "model_response")})


@query(rank_sql(RUN_PAIRS, RUN_LONG) + VERDICTS)
def evaluation_report(spark, sf):
    return dialogue_run(spark, sf).report.select(
        "metric", "best_system", "significantly_different", "notes", F.size("details").alias("n_details"))
