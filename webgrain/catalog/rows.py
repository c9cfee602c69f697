"""Scans, sinks, filters, joins, aggregates, ordering."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.functions import strings as S
from webgrain.operators import filters as P
from webgrain.operators import joins as J
from webgrain.operators import keyed
from webgrain.operators import matching as M
from webgrain.operators import ordering as O
from webgrain.operators.enrich import enrich
from webgrain.plans.scale import fresh_path, local_table
from webgrain.sources import readers as R
from webgrain.sources import sinks as K



# --- scans and sinks ------------------------------------------------------------------------


@query("select n_nationkey, n_name, n_regionkey from nation")
def scan_csv(spark, sf):
    path = fresh_path(spark, "csv")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    return R.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("""
select page_id, url, regexp_extract(url, '/(en|de|fr|es)/', 1) as crawl from pages
where url like 'https://blog.%' and regexp_extract(url, '/(en|de|fr|es)/', 1) in ('en', 'de')
""")
def scan_capture_prefix(spark, sf):
    path = fresh_path(spark, "captures")
    crawl = F.regexp_extract("url", "/(en|de|fr|es)/", 1)
    table(spark, sf, "pages").select("page_id", "url", crawl.alias("crawl")).write.partitionBy(
        "crawl").parquet(path)
    return R.scan_captures(spark, path, "https://blog.", crawls=("en", "de"))


@query("""
select doc_id, md5(text) as digest, length(text) as n_chars from documents
""")
def decode_gzip(spark, sf):
    import gzip
    from collections.abc import Iterator

    import pyarrow as pa

    @F.arrow_udf("binary")
    def pack(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield from R.in_pieces((gzip.compress(t.as_buffer(), 1) for t in batch), pa.binary())

    packed = table(spark, sf, "documents").select("doc_id", "text").select(
        "doc_id", pack("text").alias("payload"))
    return R.decode_records(packed).select(
        "doc_id", F.md5("data").alias("digest"), F.length("data").alias("n_chars"))


@query("""
select 'n_name=' || n_name as folder, cast(1 as bigint) as files, cast(strlen(c.r_name) + 1 as bigint) as length
from nation join region c on n_regionkey = c.r_regionkey
""")
def list_files(spark, sf):
    """A table written as one text file of known size per row, then listed."""
    path = fresh_path(spark, "listing")
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation.select("n_name", "r_name").write.partitionBy("n_name").text(path)
    folder = F.regexp_replace(F.element_at(F.split("path", "/"), -2), "%20", " ")
    return R.list_files(spark, path, "*.txt").groupBy(folder.alias("folder")).agg(
        F.count("*").alias("files"), F.sum("length").alias("length"))


@query("select *, 2 as n from nation")
def append_sink(spark, sf):
    path = fresh_path(spark, "append")
    nation = table(spark, sf, "nation")
    K.append_table(nation, path)
    K.append_table(nation, path)
    return spark.read.schema(nation.schema).parquet(path).groupBy(*nation.columns).agg(
        F.count("*").cast("int").alias("n"))


@query("""
select r_regionkey, r_name, snapshot from region, (values (1), (2)) v(snapshot)
""")
def snapshot_sink(spark, sf):
    base = fresh_path(spark, "snapshot")
    region = table(spark, sf, "region")
    out = None
    for _ in range(2):
        target = K.write_snapshot(region, base)
        part = spark.read.schema(region.schema).parquet(target).withColumn(
            "snapshot", F.lit(int(target.rsplit("_", 1)[1])))
        out = part if out is None else out.unionByName(part)
    return out


@query("""
select '/store/' || p_brand || '_' || p_partkey || if(p_size < 25, '.zip', '.txt') as path, p_size as length from part
where not (p_brand = 'Brand#1' and p_size < 25)
""")
def exclude_snapshots(spark, sf):
    """A listing in which the snapshots of one base are left out."""
    name = F.concat(F.lit("/store/"), "p_brand", F.lit("_"), F.col("p_partkey").cast("string"),
                    F.when(F.col("p_size") < 25, ".zip").otherwise(".txt"))
    files = table(spark, sf, "part").select(name.alias("path"), F.col("p_size").alias("length"))
    return K.exclude_snapshots(files, "Brand#1")


@query("""
with s as (select o_orderkey as path, o_orderdate as mtime from orders where o_orderstatus <> 'F'),
d as (select l_orderkey as path, max(l_shipdate) - interval 60 day as mtime from lineitem
      where l_returnflag <> 'N' group by 1)
select coalesce(s.path, d.path) as path,
  case when d.path is null then 'copy' when s.path is null then 'delete'
       when s.mtime > d.mtime then 'copy' else 'skip' end as action
from s full join d on s.path = d.path
""")
def mirror_plan(spark, sf):
    src = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("mtime"))
    dst = (
        table(spark, sf, "lineitem").filter("l_returnflag <> 'N'")
        .groupBy(F.col("l_orderkey").alias("path"))
        .agg((F.max("l_shipdate") - F.expr("interval 60 days")).alias("mtime"))
    )
    return J.mirror_plan(src, dst)


# --- filters --------------------------------------------------------------------------------


@query("""
select doc_id, source as status, lang as languages from documents
where source = 'src3' and lang = 'en'
""")
def filter_exact(spark, sf):
    captures = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("status"), F.lit("text/html").alias("mime"),
        F.col("lang").alias("languages"), F.lit("UTF-8").alias("encoding"))
    return P.filter_captures(captures, status="src3", language="en").select(
        "doc_id", "status", "languages")


@query("""
select conv_id, turn, note from (select conv_id, turn,
  case role when 'system' then '' when 'user' then text end as note from conversations)
where note is distinct from ''
""")
def filter_not_empty(spark, sf):
    note = F.when(F.col("role") == "system", "").when(F.col("role") == "user", F.col("text"))
    return P.filter_nonempty(
        table(spark, sf, "conversations").select("conv_id", "turn", note.alias("note")), "note")


@query("""
select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey
where o_orderkey is not null
""")
def filter_not_null(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return P.filter_known(customers.join(orders, "c_custkey", "left"), "o_orderkey")


def dialogue_items(spark, sf):
    """User turns with the next assistant turn, and the system text as reference."""
    turns = table(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("user_query"))
    answers = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("model_response"))
    rules = turns.filter("role = 'system'").select("conv_id", F.col("text").alias("rule"))
    return (
        asked.join(answers, ["conv_id", "turn"], "left").join(rules, "conv_id", "left")
        .withColumn("reference", F.array_compact(F.array("rule"))).drop("rule")
    )


@query("""
select u.conv_id, u.turn from conversations u
join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
join conversations s on s.conv_id = u.conv_id and s.role = 'system'
where u.role = 'user' and u.text <> '' and a.text <> ''
""")
def filter_required(spark, sf):
    return P.filter_required(
        dialogue_items(spark, sf), ["user_query", "model_response"], ["reference"]
    ).select("conv_id", "turn")


def config(spark):
    return local_table(
        spark, [("click", 0, "v1"), ("purchase", 1, None), ("view", 2, "v3")],
        "system_id string, ord int, prompt_tag string")


@query("""
select event_id, event_type as system_id from events
where event_type in ('click', 'purchase', 'view')
""")
def filter_configured(spark, sf):
    items = table(spark, sf, "events").select("event_id", F.col("event_type").alias("system_id"))
    return P.filter_configured(items, config(spark))


@query("""
select event_id, event_type as system_id,
  case event_type when 'click' then 'v1' when 'view' then 'v3' when 'purchase' then null else 'unknown' end
    as prompt_tag
from events
""")
def lookup_default(spark, sf):
    items = table(spark, sf, "events").select("event_id", F.col("event_type").alias("system_id"))
    return P.lookup_default(items, config(spark), "system_id", "prompt_tag", "unknown")


@query("select event_id, ts from events where hour(ts) >= 8 and hour(ts) < 18")
def visit_hours(spark, sf):
    return table(spark, sf, "events").filter(
        P.within_hours(F.col("ts"), F.lit(8), F.lit(18))).select("event_id", "ts")


@query("select length(text) as n_chars, md5(text) as digest from documents")
def derive_and_drop(spark, sf):
    derived = table(spark, sf, "documents").withColumns(
        {"n_chars": F.length("text"), "digest": F.md5("text")})
    return derived.drop("doc_id", "text", "lang", "source")


@query("""
select event_id, case when event_type <> 'error' then value end as metric_value,
  case when event_type not in ('error', 'view') then cast(json_extract_string(props, '$.k') as double) end
    as metric_k
from events where event_type <> 'error'
""")
def flatten_metrics(spark, sf):
    scored = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(~F.col("event_type").isin("error", "view"),
               F.get_json_object("props", "$.k")).alias("k"))
    return P.flatten_metrics(scored, ["value", "k"], ["event_id"])


@query("""
select cast(row_number() over (order by n_nationkey) - 1 as varchar) as "index",
  cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey
from nation
""")
def stringify_indexed(spark, sf):
    return P.stringify(table(spark, sf, "nation"), ["n_nationkey"])


# --- joins ----------------------------------------------------------------------------------


@query("""
with a as (select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as company from orders),
b as (select case when c_acctbal >= 0 then c_custkey end as company, count(*) as n_done
      from customer group by 1)
select a.o_orderkey, a.company, b.n_done from a left join b on a.company is not distinct from b.company
""")
def left_join_nullsafe(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("company"))
    done = table(spark, sf, "customer").groupBy(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("company")
    ).agg(F.count("*").alias("n_done"))
    return J.left_join(orders, done, "company")


@query("""
with r as (select p_name as title, min(p_brand) as content from part where p_size > 45 group by 1)
select p_partkey as "Company", p.p_name as title, r.content from part p left join r on p.p_name = r.title
""")
def enrich_left(spark, sf):
    part = table(spark, sf, "part")
    titles = part.select(F.col("p_partkey").alias("Company"), F.col("p_name").alias("title"))
    answer = F.concat(F.lit('{"query":{"pages":{"7":{"extract":"'), F.min("p_brand"), F.lit('"}}}}'))
    responses = part.filter("p_size > 45").groupBy(F.col("p_name").alias("title")).agg(
        answer.alias("body"))
    return enrich(titles, responses)


@query("""
select q.c_name as query, t.c_custkey as pos, t.c_name as term from customer q, customer t
where levenshtein(q.c_name, t.c_name) <= 1
""")
def edit1_match(spark, sf):
    customers = table(spark, sf, "customer")
    return M.match_edit1(
        customers.select(F.col("c_name").alias("query")),
        customers.select(F.col("c_name").alias("term"), F.col("c_custkey").alias("pos")))


@query("""
with c as (select p_name as term, min(p_partkey) as pos from part group by 1)
select a.term as query, b.pos, b.term from c a, c b where levenshtein(a.term, b.term) <= 2
""")
def editk_match(spark, sf):
    names = table(spark, sf, "part").groupBy(F.col("p_name").alias("term")).agg(
        F.min("p_partkey").alias("pos"))
    return M.match_edit(names.select(F.upper("term").alias("query")), names, k=2)


@query("""
with q as (select distinct lower(p_type) as query from part), c as (select p_name as term, min(p_partkey) as pos from part group by 1),
m as (select q.query, c.pos, c.term from q, c where levenshtein(q.query, c.term) <= 3
  union all select a.term, b.pos, b.term from c a, c b where levenshtein(a.term, b.term) <= 3)
select q.query, m.pos, m.term from (select query from q union select term from c) q left join m using (query)
""")
def edit3_match(spark, sf):
    """Names and types, of which most match nothing, against the names."""
    part = table(spark, sf, "part")
    names = part.groupBy(F.col("p_name").alias("term")).agg(F.min("p_partkey").alias("pos"))
    asked = names.select(F.col("term").alias("query")).unionByName(part.select(F.col("p_type").alias("query")).distinct())
    return M.match_edit(asked, names, k=3)


STYLES = {"click": "question"}
EXTENDER = {"view": "answer", "click": "tap"}


@query("""
with e as (select event_id, value,
  case event_type when 'signup' then 'signup question' when 'error' then 'answer error'
    else event_type end as style from events)
select event_id, case
  when value > 20 and style = 'view' then 'answer' when value > 20 and style = 'click' then 'tap'
  when style = 'click' then 'question' when contains(style, 'question') then 'question'
  when contains(style, 'answer') then 'answer' else style end as style from e
""")
def normalize_style(spark, sf):
    event_type = F.col("event_type")
    style = (
        F.when(event_type == "signup", "signup question")
        .when(event_type == "error", "answer error").otherwise(event_type)
    )
    return table(spark, sf, "events").select(
        "event_id", S.normalize_style(style, F.col("value"), STYLES, EXTENDER, 20).alias("style"))


TYPED = ["customer#00000001", "99", "", "XYZ", "r#0000001"]


@query("""
with q(query) as (values ('customer#00000001'), ('99'), (''), ('XYZ'), ('r#0000001'))
select query, c_name as term, c_custkey as pos from q, customer
where contains(lower(c_name), lower(query))
qualify row_number() over (partition by query order by c_custkey) <= 5
""")
def autocomplete(spark, sf):
    catalog = table(spark, sf, "customer").select(
        F.col("c_name").alias("term"), F.col("c_custkey").alias("pos"))
    return M.suggest(TYPED, catalog)


@query("""
with q as (select distinct substr(p_name, 2, 3) as query from part union all select '')
select query, p_name as term, p_partkey as pos from q, part where contains(lower(p_name), lower(query))
qualify row_number() over (partition by query order by p_partkey) <= 5
""")
def autocomplete_table(spark, sf):
    part = table(spark, sf, "part")
    typed = part.select(F.substring("p_name", 2, 3).alias("query")).distinct().union(
        local_table(spark, [("",), (None,)], "query string"))
    return M.suggest(typed, part.select(F.col("p_name").alias("term"), F.col("p_partkey").alias("pos")))


@query("""
with a as (select d.source as site, bool_or(l.toxic = 1 and d.lang = 'de') as denied
           from documents d join labels l using (doc_id) group by 1)
select s.source as site, not coalesce(a.denied, false) as allowed
from (select distinct source from documents) s left join a on a.site = s.source
""")
def terms_verdict(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", F.col("source").alias("site"), "lang")
    denied = (F.col("toxic") == 1) & (F.col("lang") == "de")
    answers = documents.join(table(spark, sf, "labels"), "doc_id").select(
        "site", F.when(denied, " '0'. ").otherwise("1").alias("answer"))
    return J.fold_verdicts(documents.select("site").distinct(), answers)


# --- aggregates -----------------------------------------------------------------------------


@query("select count(*) as n_rows, 3 as n_cols from pages")
def shape(spark, sf):
    return J.shape(table(spark, sf, "pages"))


@query("select user_id, arg_max(event_type, event_id) as event_type from events group by 1")
def last_value_per_key(spark, sf):
    return J.last_per_key(table(spark, sf, "events"), "user_id", "event_type", "event_id")


# --- ordering -------------------------------------------------------------------------------


@query("""
select user_id, event_id, if(event_id % 97 = 5, null, ts) as ts, event_type from events
qualify row_number() over (
  partition by user_id order by if(event_id % 97 = 5, null, ts) desc nulls first, event_id desc) = 1
""")
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 97 != 5, F.col("ts")).alias("ts"), "event_type")
    return O.latest_per_key(events, "user_id", "ts", ["event_id"])


@query("""
with e as (select *, list_position(['view', 'click', 'purchase'], event_type) as ord from events
           where event_type in ('view', 'click', 'purchase')),
n as (select *, row_number() over (order by ord, event_id) as eval_count from e)
select event_id as item, event_type as system_id, eval_count,
  'run_20240101000000_' || eval_count as run_id,
  case event_type when 'click' then 'v1' when 'view' then 'v3' else 'unknown' end as prompt_tag
from n where value > 20
""")
def run_ids(spark, sf):
    order = F.array(*[F.lit(s) for s in ("view", "click", "purchase", "error", "signup")])
    items = table(spark, sf, "events").select(
        F.array_position(order, F.col("event_type")).alias("system_ord"),
        F.col("event_type").alias("system_id"), F.col("event_id").alias("item"),
        F.col("event_type").alias("user_query"), F.array("props").alias("reference"),
        F.when(F.col("value") > 20, F.col("props")).otherwise("").alias("model_response"))
    return P.prepare_items(items, config(spark), "20240101000000").select(
        "item", "system_id", "eval_count", "run_id", "prompt_tag")


@query("""
select o_orderkey, cast(floor((row_number() over (order by o_orderkey) - 1) / 500) as bigint) as chunk
from orders
""")
def chunk_ids(spark, sf):
    return O.chunk_id(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 500)


@query("select event_id, ts, value from events order by value desc, event_id limit 100")
def sort_limit(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "value").orderBy(
        F.desc("value"), "event_id").limit(100)


@query("""
select c_custkey, c_name from customer order by md5(c_custkey || ':0'), c_custkey limit 100
""")
def sample_n(spark, sf):
    return O.sample_exact(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 100)


@query("""
select doc_id, row_number() over (order by md5(doc_id || ':7'), doc_id) as rank from documents
""")
def shuffle_rank(spark, sf):
    return O.shuffle(table(spark, sf, "documents").select("doc_id"), "doc_id", seed=7)


# --- sets -----------------------------------------------------------------------------------


@query("""
select c_custkey as id, c_name as name, c_mktsegment from customer
union all select s_suppkey, s_name, null from supplier
""")
def union_by_name(spark, sf):
    return J.concat(
        table(spark, sf, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"),
        table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("select c_nationkey as k from customer intersect select s_nationkey from supplier")
def intersect_sets(spark, sf):
    return J.common(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")))


# --- user functions -------------------------------------------------------------------------


@query("""
select distinct p_name, upper(p_name) as result from part where not starts_with(p_name, 'red')
""")
def apply_keyed(spark, sf):
    return keyed.apply_keyed(
        table(spark, sf, "part"), "p_name", lambda s: None if s.startswith("red") else s.upper())


