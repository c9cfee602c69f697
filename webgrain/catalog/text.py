"""Text, URL, robots and money functions."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.functions import money, strings as S, tables as T, urls as U
from webgrain.operators import filters as P
from webgrain.operators import joins as J
from webgrain.operators import ordering as O
from webgrain.operators import robots as B
from webgrain.operators.domains import registered_domain as add_domain
from webgrain.plans import jobs
from webgrain.plans.scale import fresh_path, local_table
from webgrain.operators.enrich import first_article_title

# RE2 class with the characters of Python's str.strip()
SQL_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query(rf"""
with l as (select doc_id, list_filter(list_transform(
    regexp_split_to_array(text, '[\x0a-\x0d\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'),
    lambda x: regexp_replace(x, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')), lambda x: x <> '') as lines
  from documents)
select doc_id, md5(coalesce(array_to_string(lines, chr(10)), '')) as digest, len(lines) as n_lines from l
""")
def clean_lines(spark, sf):
    cleaned = texts(spark, sf).select("doc_id", S.clean_lines(F.col("text")).alias("t"))
    lines = F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", "\n")))
    return cleaned.select("doc_id", F.md5("t").alias("digest"), lines.alias("n_lines"))


# e: end of a word, with its space; nxt: end of the chunk that starts after e
PARTITION_SQL = """
with recursive ws as (select doc_id, string_split(text, ' ') as ws from documents),
w as (select doc_id, 0 as e from ws union all
  select doc_id, cast(sum(len(x) + 1) over (partition by doc_id order by i) as int) as e
  from (select doc_id, unnest(ws) as x, generate_subscripts(ws, 1) as i from ws)),
n as (select doc_id, e, case when far > e then far else lead end as nxt from (
  select doc_id, e, max(e) over (partition by doc_id order by e range between current row and {n} + 1 following) as far,
    lead(e) over (partition by doc_id order by e) as lead from w)),
c as (
  select n.doc_id, e, nxt, case when len(ws[1]) >= {n} then 1 else 0 end as chunk
  from n join ws using (doc_id) where e = 0
  union all
  select c.doc_id, n.e, n.nxt, c.chunk + 1 from c join n on n.doc_id = c.doc_id and n.e = c.nxt
  where n.nxt is not null)
select doc_id, chunk, md5(substr(text, e + 1, nxt - e - 1)) as digest from c join documents using (doc_id)
union all select doc_id, 0, md5('') from ws where len(ws[1]) >= {n}
"""


@query(PARTITION_SQL.format(n=2048))
def partition_text(spark, sf):
    chunks = S.partition_text(F.col("text"))
    return texts(spark, sf).select(
        "doc_id", F.posexplode(chunks).alias("chunk", "body")
    ).select("doc_id", "chunk", F.md5("body").alias("digest"))


@query(PARTITION_SQL.format(n=2048))
def chunks_lateral(spark, sf):
    """The chunks by a table function behind LATERAL."""
    T.register(spark)
    return spark.sql(
        "select doc_id, chunk, md5(body) as digest from {docs} d, lateral text_chunks(d.text, 2048)", docs=texts(spark, sf))


@query(PARTITION_SQL.format(n=2048))
def chunks_of_pieces(spark, sf):
    """The chunks of texts that come as rows of up to 200 words."""
    T.register(spark)
    words = F.split("text", " ")
    starts = F.sequence(F.lit(1), F.size("words"), F.lit(200))
    pieces = texts(spark, sf).select("doc_id", words.alias("words")).select(
        "doc_id", F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, 200), " "))).alias("place", "part"))
    return spark.sql(
        "select doc_id, chunk, md5(body) as digest from chunks_of(table({pieces}), 'doc_id', 'place', 'part', 2048)", pieces=pieces)


@query(rf"""
select doc_id, md5(regexp_replace(text, '{SQL_SPACE}+$', '')) as digest from documents
""")
def split_payload(spark, sf):
    wrapped = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"), F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(S.http_body(wrapped)).alias("digest"))


@query("""
select doc_id, md5(chr(10) || '    Please summarize the following text in a clear, well-organized, and easy-to-understand manner:'
  || chr(10) || '    Content: ' || text || chr(10) || '    Summary: '
  || coalesce(case quality when 1 then 'good' when 0 then 'bad' end, 'None') || chr(10) || '    ') as digest
from documents left join labels using (doc_id)
""")
def build_prompt(spark, sf):
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("summary"))
    joined = table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id", "left")
    return joined.select("doc_id", F.md5(S.prompt(F.col("text"), F.col("summary"))).alias("digest"))


@query("select p_partkey, replace(p_name, ' ', '-') as slug from part")
def slugify(spark, sf):
    padded = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("\t ")), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", S.slugify(padded).alias("slug"))


@query("""
select event_id, case when event_type in ('error', 'signup') then '' else event_type end as extract
from events
""")
def json_first_extract(spark, sf):
    kind = F.col("event_type")
    body = (
        F.when(kind == "error", F.lit("{bad"))
        .when(kind == "signup", F.lit('{"query":{"pages":{"1":{"title":"x"}}}}'))
        .otherwise(F.concat(F.lit('{"query":{"pages":{"'), F.col("event_id").cast("string"),
                            F.lit('":{"extract":"'), kind, F.lit('"}}}}')))
    )
    return table(spark, sf, "events").select("event_id", S.json_first_extract(body).alias("extract"))


# --- urls -----------------------------------------------------------------------------------


@query("""
with u as (select page_id, regexp_replace(url, '^https://', '') as u from pages),
f as (select page_id, case when starts_with(u, 'http') then u else 'http://' || u end as u from u)
select page_id, case when u like '%/' then u else u || '/' end as url from f
""")
def normalize_url(spark, sf):
    bare = F.regexp_replace("url", "^https://", "")
    return table(spark, sf, "pages").select("page_id", U.normalize_url(bare).alias("url"))


@query("select page_id, regexp_extract(url, '^(https?://[^/]*)', 1) || '/robots.txt' as robots from pages")
def robots_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.robots_url(F.col("url")).alias("robots"))


@query("""
select page_id, regexp_extract(url, '://([^/?#]*)', 1) || ':80' as netloc,
  regexp_extract(url, '://[^/]*([^?#]*)', 1) || '/a%20b+c%C3%A9' as path,
  regexp_extract(url, '://[^/]*([^?#]*)', 1) || '/a b+cé' as plain
from pages
""")
def url_parts(spark, sf):
    odd = F.regexp_replace("url", r"^([^/]*//[^/]*)([^?#]*)", "$1:80$2/a%20b+c%C3%A9;p=1")
    return table(spark, sf, "pages").select(
        "page_id", U.netloc(odd).alias("netloc"), U.path(odd).alias("path"),
        U.unquote(U.path(odd)).alias("plain"))


SUFFIXES = ["com", "net", "org", "uk", "co.uk", "example.com", "example.net", "example.org"]
DOMAIN_CTE = """
with sfx(s) as (values ('com'), ('net'), ('org'), ('uk'), ('co.uk'), ('example.com'), ('example.net'),
  ('example.org')),
h as (select page_id, url, regexp_extract(url, '://([^/?#]*)', 1) as host from pages),
best as (select page_id, max_by(s, length(s)) as s from h join sfx on ends_with(host, '.' || s) group by 1),
d as (select h.page_id, h.url, h.host,
        regexp_extract(left(host, length(host) - length(s) - 1), '([^.]*)$', 1) || '.' || s as domain
      from h left join best using (page_id))
"""


def suffixes(spark):
    return local_table(spark, [(s,) for s in SUFFIXES], "suffix string")


def paged_domains(spark, sf, *columns):
    pages = table(spark, sf, "pages").select("page_id", "url", *columns)
    return add_domain(pages, "url", suffixes(spark), max_labels=2)


@query(DOMAIN_CTE + "select page_id, domain from d")
def registered_domain(spark, sf):
    return paged_domains(spark, sf).select("page_id", "domain")


@query(r"""
with h as (select page_id, regexp_extract(url, '://([^/?#]*)', 1) as host from pages)
select page_id, nullif(case
  when host like '%example.com' then 'example.com'
  when host like '%thther.example.org' then 'thther.example.org'
  else regexp_extract(host, '([^.]+[.][^.]+[.]example[.](?:net|org))$', 1) end, '') as domain from h
""")
def registered_domain_rules(spark, sf):
    """Wildcard rules and an exception to one."""
    rules = [(s,) for s in ("com", "net", "org", "*.example.net", "*.example.org", "!thther.example.org")]
    pages = table(spark, sf, "pages").select("page_id", "url")
    return add_domain(pages, "url", local_table(spark, rules, "suffix string"), max_labels=3).select("page_id", "domain")


@query(DOMAIN_CTE + "select domain, count(*) as n from d where domain is not null group by 1")
def count_by_domain(spark, sf):
    return J.count_by(paged_domains(spark, sf), "domain")


@query(DOMAIN_CTE + """
, starts as (select domain from d group by 1 having count(*) >= 5)
select page_id, domain from d where domain in (select domain from starts)
  and length(url) - length(replace(url, '/', '')) - 2 < 3
""")
def frontier_filter(spark, sf):
    pages = paged_domains(spark, sf)
    starts = J.count_by(pages, "domain").filter("n >= 5")
    return P.frontier(pages, "url", starts, max_depth=3).select("page_id", "domain")


@query(DOMAIN_CTE + """
select page_id, domain from d qualify row_number() over (partition by domain
  order by length(url) - length(replace(url, '/', '')), url, page_id) <= 10
""")
def cap_per_domain(spark, sf):
    pages = paged_domains(spark, sf)
    return O.cap_per_key(pages, "domain", [U.depth(F.col("url")), "url", "page_id"]).select(
        "page_id", "domain")


TRUST = ["blog.tionsh.example.net", "thther.example.org", "m.ththth.example.net",
         "blog.ththan.example.net"]


@query("""
select regexp_extract(url, '/(en|de|fr|es)/', 1) as query,
  count(distinct regexp_extract(url, '://([^/?#]*)', 1)) filter (regexp_extract(url, '://([^/?#]*)', 1)
    in ('blog.tionsh.example.net', 'thther.example.org', 'm.ththth.example.net',
        'blog.ththan.example.net')) >= 2 as trusted
from pages group by 1
""")
def trusted_presence(spark, sf):
    host = U.netloc(F.col("url"))
    hits = table(spark, sf, "pages").groupBy(
        F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("query")
    ).agg(F.collect_set(F.when(host.isin(*TRUST), host)).alias("hosts"))
    return hits.select("query", J.trusted(F.col("hosts"), TRUST, 2).alias("trusted"))


@query("""
with h as (select regexp_extract(url, '/(en|de|fr|es)/', 1) as query, page_id,
  regexp_extract(url, '://([^/?#]*)', 1) as host,
  replace(regexp_extract(url, '://[^/]*([^?#]*)', 1), '/en/', '') as title from pages)
select query, case when count(distinct host) filter (host in ('blog.tionsh.example.net',
    'thther.example.org', 'm.ththth.example.net', 'blog.ththan.example.net')) >= 2
  then coalesce(arg_min(title, page_id) filter (host = 'blog.tionsh.example.net'), '') else '' end as title
from h group by 1
""")
def first_hit_title(spark, sf):
    hits = table(spark, sf, "pages").select(
        F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("query"), F.col("page_id").alias("rank"),
        "url")
    return first_article_title(hits, host=TRUST[0], trust_list=TRUST, prefix="/en/")


@query("""
with h as (select regexp_extract(url, '/(en|de|fr|es)/', 1) as query, page_id,
  regexp_extract(url, '://([^/?#]*)', 1) as host,
  replace(regexp_extract(url, '://[^/]*([^?#]*)', 1), '/en/', '') as title from pages),
t as (select query, case when count(distinct host) filter (host in ('blog.tionsh.example.net',
    'thther.example.org', 'm.ththth.example.net', 'blog.ththan.example.net')) >= 2
  then coalesce(arg_min(title, page_id) filter (host = 'blog.tionsh.example.net'), '') else '' end as title
  from h group by 1),
r as (select title, cast(min(page_id) as varchar) as content from h where title <> '' group by 1)
select c.company as "Company", coalesce(t.title, '') as title, r.content
from (select distinct query as company from h union all select 'none of these') c
left join t on t.query = c.company left join r on r.title = t.title
""")
def company_enrichment(spark, sf):
    """Languages stand for companies: hits and responses come from their pages."""
    pages = table(spark, sf, "pages").select(
        F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("query"), F.col("page_id").alias("rank"), "url")
    companies = pages.select(F.col("query").alias("Company")).distinct().union(
        local_table(spark, [("none of these",), (None,)], "Company string"))
    done = companies.filter("Company = 'en'").withColumn("seen", F.lit(True))
    title = F.replace(U.path(F.col("url")), F.lit("/en/"), F.lit(""))
    responses = pages.groupBy(title.alias("title")).agg(F.concat(
        F.lit('{"query":{"pages":{"7":{"extract":"'), F.min("rank").cast("string"), F.lit('"}}}}')).alias("body"))
    out = fresh_path(spark, "enriched")
    found = jobs.company_enrichment(companies, done, pages, responses, out=out, host=TRUST[0], trust_list=TRUST,
                                    prefix="/en/")
    return spark.read.schema(found.schema).parquet(out)


@query(DOMAIN_CTE + """
, near as (select page_id, domain, url from d where domain in (select domain from d where page_id % 3 = 0)
  and length(url) - length(replace(url, '/', '')) - 2 < 3),
capped as (select domain from near qualify row_number() over (partition by domain
  order by length(url) - length(replace(url, '/', '')), url, page_id) <= 10)
select domain, count(*) as n from capped group by 1
""")
def crawl_report(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return jobs.crawl_report(
        pages, pages.filter("page_id % 3 = 0"), lambda df: add_domain(df, "url", suffixes(spark), max_labels=2),
        [U.depth(F.col("url")), "url", "page_id"], max_depth=3)


# --- robots ---------------------------------------------------------------------------------


def site_robots(spark, sf):
    """One robots text per host: its first language is closed to all; blogs have a group for
    ``webbot``."""
    pages = table(spark, sf, "pages").select(
        U.netloc(F.col("url")).alias("host"), F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("l"))
    general = F.concat(F.lit("User-agent: *\nCrawl-delay: x\nDisallow: /"), F.min("l"), F.lit("/ # all"))
    special = F.lit("\n\nUser-agent: WebBot/2\nUser-agent: webbot\nAllow: /en/1\nDisallow: /en/"
                    "\nRequest-rate: 1/10\n")
    blog = F.when(F.col("host").startswith("blog."), special).otherwise(F.lit(""))
    return pages.groupBy("host").agg(F.concat(general, blog).alias("robots_txt"))


@query("""
with h as (select page_id, regexp_extract(url, '://([^/?#]*)', 1) as host,
  regexp_extract(url, '://[^/]*(.*)$', 1) as path, regexp_extract(url, '/(en|de|fr|es)/', 1) as l from pages),
r as (select host, min(l) as l from h group by 1)
select page_id, case when starts_with(host, 'blog.') then
    starts_with(path, '/en/1') or not starts_with(path, '/en/')
  else not starts_with(path, '/' || r.l || '/') end as allowed
from h join r using (host)
""")
def robots_allowed(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", U.netloc(F.col("url")).alias("host"))
    return B.robots_allowed(pages, site_robots(spark, sf), "webbot/1.0").select("page_id", "allowed")


@query("""
with h as (select regexp_extract(url, '://([^/?#]*)', 1) as host,
  min(regexp_extract(url, '/(en|de|fr|es)/', 1)) as l from pages group by 1)
select host, line, grp as "group", kind, replace(value, '@', l) as value from h, (values
  (0, 0, 'user-agent', '*'), (1, 0, 'crawl-delay', 'x'), (2, 0, 'disallow', '/@/'),
  (4, 1, 'user-agent', 'WebBot/2'), (5, 1, 'user-agent', 'webbot'), (6, 1, 'allow', '/en/1'),
  (7, 1, 'disallow', '/en/'), (8, 1, 'request-rate', '1/10')) v(line, grp, kind, value)
where line < 3 or starts_with(host, 'blog.')
""")
def robots_rules(spark, sf):
    return B.robots_rules(site_robots(spark, sf), "host", "robots_txt")


@query("""
with h as (select regexp_extract(url, '://([^/?#]*)', 1) as host, min(page_id) as p from pages group by 1)
select host, case when starts_with(host, 'blog.') then null else cast(p % 9 as int) end as delay,
  case when starts_with(host, 'blog.') then cast(p % 5 + 1 as int) end as requests,
  case when starts_with(host, 'blog.') then 10 end as seconds,
  case when p % 2 = 0 then 6 end as visit_start, case when p % 2 = 0 then cast(9 + p % 8 as int) end as visit_end
from h
""")
def crawl_directives(spark, sf):
    """Delays, rates and visit times per host; one group gives no delay, odd hosts a malformed time."""
    p = F.min("page_id")
    text = F.concat(
        F.lit("User-agent: *\nDisallow: /x\nCrawl-delay: "), (p % 9).cast("string"),
        F.when(F.first("host").startswith("blog."), F.concat(
            F.lit("\n\nUser-agent: webbot\nCrawl-delay: soon\nRequest-rate: "), (p % 5 + 1).cast("string"), F.lit("/10")))
        .otherwise(F.lit("")),
        F.lit("\nVisit-time: 6-"), F.when(p % 2 == 0, (9 + p % 8).cast("string")).otherwise(F.lit("late")), F.lit("\n"))
    hosts = table(spark, sf, "pages").select("page_id", U.netloc(F.col("url")).alias("host")).groupBy("host").agg(
        text.alias("robots_txt"))
    return B.crawl_directives(hosts, "webbot/1.0")


# --- money ----------------------------------------------------------------------------------

_P, _R = "abs(c_acctbal) + 100", "1 + c_nationkey / 7.0"
_Y, _N = "c_nationkey + 5", "c_nationkey"


def accounts(spark, sf):
    key = F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        "c_custkey", (F.abs("c_acctbal") + 100).alias("principal"),
        (F.lit(1.0) + key / F.lit(7.0)).alias("rate"), (key + 5).alias("years"), key.alias("premium"))


_ARGS = ("principal", "rate", "years", "premium")


@query(f"select c_custkey, round(({_P}) * pow(1 + ({_R}) / 100, {_Y}), 2) as amount from customer")
def fixed_deposit(spark, sf):
    p, r, y, _ = map(F.col, _ARGS)
    return accounts(spark, sf).select("c_custkey", money.fixed_deposit(p, r, y).alias("amount"))


_RD = """round(({p}) * ((pow(1 + ({r}) / 400, ({y}) * 4) - 1) / (1 - pow(1 + ({r}) / 400, -1.0 / 3.0))), 2)"""


@query(f"select c_custkey, {_RD.format(p=_P, r=_R, y=_Y)} as amount from customer")
def recurring_deposit(spark, sf):
    p, r, y, _ = map(F.col, _ARGS)
    return accounts(spark, sf).select("c_custkey", money.recurring_deposit(p, r, y).alias("amount"))


@query(f"""
select c_custkey, round(coalesce(sum(round(({_P}) * pow(1 + ({_R}) / 100, {_Y} - i), 2)), 0), 2) as amount,
from customer left join range(0, 25) t(i) on i < {_N} group by c_custkey
""")
def deposit_ladder(spark, sf):
    amount = F.round(money.deposit_ladder(*map(F.col, _ARGS)), 2)
    return accounts(spark, sf).select("c_custkey", amount.alias("amount"))


@query(f"""
with a as (select c_custkey, round({_RD.format(p=_P, r=_R, y=_N)} * pow(1 + ({_R}) / 100, 5), 2) as amount
           from customer)
select c_custkey, amount, cast(trunc(amount / 100000) as int) as lakhs from a
""")
def deposit_rd_then_fd(spark, sf):
    amount = money.rd_then_fd(*map(F.col, _ARGS))
    return accounts(spark, sf).select(
        "c_custkey", amount.alias("amount"), money.lakhs(amount).alias("lakhs"))
