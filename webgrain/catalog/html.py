"""Queries over page markup."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.catalog.text import DOMAIN_CTE, SQL_SPACE, suffixes
from webgrain.functions import dom as D
from webgrain.functions.tables import register
from webgrain.operators import crawl as C
from webgrain.operators.domains import registered_domain
from webgrain.plans import jobs
from webgrain.plans.scale import fresh_path, materialize
from webgrain.sources import sinks as K
from webgrain.sources.readers import read_bodies
from webgrain.sources.records import read_records, write_records

ENTITIES = """regexp_replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
  '&amp;?', '&', 'g')"""
# markup without comments and without what is inside script and style
BARE = r"regexp_replace(html, '(?s)<!--.*?-->|<(script|style)>.*?</(script|style)>', '<x>', 'g')"
DOM_CTE = rf"""
with m as (select page_id, url, {BARE} as html from pages),
a as (select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) as href,
        unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) as txt,
        unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">', 1)))) as ord from m),
links as (select page_id, url, ord, {ENTITIES.format('href')} as href, {ENTITIES.format('txt')} as txt,
  regexp_extract(url, '^(https?://[^/]*)', 1) as site from a)
"""


def pieces(markup):
    """SQL list of stripped text pieces between tags."""
    return rf"""list_filter(list_transform(regexp_split_to_array({markup}, '<[^>]*>'),
      lambda x: regexp_replace({ENTITIES.format('x')}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')),
      lambda x: x <> '')"""


def lines(text):
    return rf"""array_to_string(list_filter(list_transform(regexp_split_to_array({text}, '\n'),
      lambda x: regexp_replace(x, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')), lambda x: x <> ''), chr(10))"""


BODY = f"""array_to_string({pieces("regexp_extract(html, '(?s)<body>.*')")}, chr(10))"""
TITLE = ENTITIES.format("regexp_extract(html, '<title>([^<]*)', 1)")


def pages(spark, sf, tags=None, html=None):
    """The page table with its markup shredded."""
    df = table(spark, sf, "pages")
    if html is not None:
        df = df.withColumn("html", html)
    return C.shred(df, tags=tags)


TAG_COUNTS = rf"""
with m as (select {BARE} as html from pages),
t as (select unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[^>]*>', 1)) as tag from m
      union all select regexp_extract(s, '<([a-z]+)', 1) from
        (select unnest(regexp_extract_all(html, '<(script|style)>')) as s from pages))
select tag, count(*) as n from t where tag <> 'x' group by 1
"""


@query(TAG_COUNTS)
def shred_tag_counts(spark, sf):
    tags = pages(spark, sf).select(F.explode("dom.nodes.tag").alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


@query(TAG_COUNTS)
def elements_lateral(spark, sf):
    """The tags by a table function behind LATERAL."""
    register(spark)
    return spark.sql("select tag, count(*) as n from {pages} p, lateral page_elements(p.html) group by tag",
                     pages=table(spark, sf, "pages").select("html"))


@query(rf"""
with m as (select page_id, {BARE} as html from pages),
t as (select page_id, {ENTITIES.format("regexp_replace(html, '<[^>]*>', '', 'g')")} as t from m)
select page_id, md5({lines('t')}) as digest from t
""")
def page_text(spark, sf):
    return pages(spark, sf, tags=[]).select("page_id", F.md5(D.page_text(F.col("dom"))).alias("digest"))


ITEM_SQL = rf"""
with m as (select url, {BARE} as html from pages)
select url, {TITLE} as title, md5({BODY}) as body from m
"""


@query(ITEM_SQL)
def page_item(spark, sf):
    items = C.page_items(pages(spark, sf, tags=["title", "body"]))
    return items.withColumn("body", F.md5("body"))


@query(ITEM_SQL)
def sink_roundtrip(spark, sf):
    path = fresh_path(spark, "items")
    K.write_items(C.page_items(pages(spark, sf, tags=["title", "body"])), path)
    return K.read_items(spark, path).withColumn("body", F.md5("body"))


@query(rf"""
with m as (select page_id, url, regexp_extract(url, '/(en|de|fr|es)/', 1) as l, {BARE} as html from pages),
t as (select page_id, l, {TITLE} as title from m)
select page_id, case l when 'en' then title || '. d' || page_id
  when 'de' then 'Home Page of the company | ' || title else title end as url_metadata from t
""")
def url_metadata(spark, sf):
    described = F.when(
        F.col("url").contains("/en/"),
        F.replace("html", F.lit("<title>"), F.concat(
            F.lit("<meta name=\"description\" content='d"), F.col("page_id").cast("string"),
            F.lit("'><title>"))),
    ).otherwise(F.col("html"))
    home = F.regexp_replace("url", "/de/.*$", "/")
    return pages(spark, sf, ["title", "meta"], described).select(
        "page_id", D.url_metadata(F.col("dom"), home).alias("url_metadata"))


@query(DOM_CTE + """
select page_id, cast(row_number() over (partition by page_id order by min(ord)) - 1 as int) as ord,
  site || href as dst from links group by page_id, site, href
""")
def resolve_links(spark, sf):
    return C.link_edges(pages(spark, sf, ["a"]), keep=["page_id"]).select("page_id", "ord", "dst")


@query(DOM_CTE + """
select url as src, cast(row_number() over (partition by page_id order by min(ord)) - 1 as int) as ord,
  site || href as dst from links where site like '%example.org' or site like '%//www.ththhe.example.com'
group by page_id, url, site, href
""")
def link_edges(spark, sf):
    return C.link_edges(pages(spark, sf, ["a"]), domains=["example.org", "www.ththhe.example.com"])


@query(DOM_CTE + """
select page_id, cast(row_number() over (partition by page_id order by min(ord)) - 1 as int) as ord, site || href as dst
from links group by page_id, site, href
qualify regexp_matches(site || href, '^https?://[^/]*[.]org/') or regexp_matches(site || href, 'an$')
""")
def link_patterns(spark, sf):
    return C.link_edges(pages(spark, sf, ["a"]), keep=["page_id"], patterns=["^https?://[^/]*[.]org/", "an$"]).select(
        "page_id", "ord", "dst")


@query(DOM_CTE + """
, hits as (select page_id, url, href, case when regexp_matches(txt, '(?i)the') then 1
    when regexp_matches(href, '(?i)the') then 2 when regexp_matches(txt, '(?i)an') then 3 end as pass, ord
  from links)
, best as (select page_id, arg_min(href, (pass, ord)) as href from hits where pass is not null group by 1)
select p.page_id, case when p.url like '%/' then p.url else p.url || '/' end || '/' || ltrim(href, '/') as link
from pages p left join best using (page_id)
""")
def terms_link(spark, sf):
    link = D.terms_link(F.col("dom"), F.col("url"), ["the", "an"])
    return pages(spark, sf, ["a"]).select("page_id", link.alias("link"))


@query(DOM_CTE + """
, best as (select page_id, arg_min(site || href, ord) as link from links
  where lower(trim(txt)) in ('the', 'and') or contains(lower(replace(href, '/', ' ')), 'the')
    or contains(lower(replace(href, '/', ' ')), 'and') group by 1)
select page_id, link from pages left join best using (page_id)
""")
def about_link(spark, sf):
    link = D.about_link(F.col("dom"), F.col("url"), ["the", "and"])
    return pages(spark, sf, ["a"]).select("page_id", link.alias("link"))


@query(DOM_CTE + """
, best as (select page_id, arg_min(site || href, ord) as link from links where contains(lower(txt), 'th')
  group by 1)
select page_id, link from pages left join best using (page_id)
""")
def region_link(spark, sf):
    link = D.region_link(F.col("dom"), F.col("url"), "th")
    return pages(spark, sf, ["a"]).select("page_id", link.alias("link"))


@query(DOM_CTE + """
select page_id, cast(ord as int) as ord, 'https://mirror' || href as link from links where ord < 5
""")
def first_n_links(spark, sf):
    return C.first_links(pages(spark, sf, ["a"]), None, 5, "https://mirror", keep=["page_id"])


@query(DOM_CTE + """
select page_id, cast(ord as int) as ord, href as link from links where ord < 3 and page_id % 2 = 0
""")
def first_class_links(spark, sf):
    """Links of every second page get a class, of which the first three are wanted."""
    marked = F.when(F.col("page_id") % 2 == 0, F.replace("html", F.lit("<a href"), F.lit('<a class="photo big" href')))
    html = table(spark, sf, "pages").withColumn("html", F.coalesce(marked, "html"))
    return C.first_links(C.shred(html, tags=["a"]), "photo", 3, keep=["page_id"])


POPUP_WORDS = ["thth", "zuver", "ention"]


@query(rf"""
with m as (select page_id, {BARE} as html from pages),
b as (select page_id, lower(array_to_string({pieces("regexp_extract(html, '(?s)<div[^>]*>(.*?)</div>', 1)")}, '')) as d,
  lower(array_to_string({pieces("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")}, '')) as a,
  lower(array_to_string({pieces("regexp_extract(html, '(?s)<footer>(.*)', 1)")}, '')) as f from m),
h as (select page_id, case when contains(d, 'thth') then 'div/thth' when contains(d, 'zuver') then 'div/zuver'
    when contains(d, 'ention') then 'div/ention'
    when contains(a, 'thth') then 'article/thth' when contains(a, 'zuver') then 'article/zuver'
    when contains(a, 'ention') then 'article/ention'
    when contains(f, 'thth') then 'footer/thth' when contains(f, 'zuver') then 'footer/zuver'
    when contains(f, 'ention') then 'footer/ention' else 'div/.ad' end as e from b)
select page_id, true as flag, if(e like '%.ad', 'selector', 'text') as kind,
  split_part(e, '/', 1) as tag, split_part(e, '/', 2) as hit from h
""")
def popup_evidence(spark, sf):
    return C.popup_evidence(pages(spark, sf), keywords=POPUP_WORDS, selectors=[".popup", ".ad"],
                            keep=["page_id"])


AD = pieces("""regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)""")


@query(rf"""
with m as (select page_id, {BARE} as html from pages)
select page_id, 'ad' as role, regexp_replace({ENTITIES.format("regexp_replace(regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1), '<[^>]*>', '', 'g')")},
  '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g') as text from m
""")
def role_elements(spark, sf):
    return C.role_elements(pages(spark, sf), ["popup", "ad"], keep=["page_id"],
                           attribute="class").drop("ord")


@query(rf"""
with m as (select page_id, {BARE} as html from pages),
d as (select page_id, lower(array_to_string({AD}, '')) as t from m)
select page_id, $$div[class='ad']$$ as selector, 'div' as tag, t as text from d
where contains(t, 'thth') or contains(t, 'zuver')
""")
def interaction_evidence(spark, sf):
    return C.interaction_evidence(
        pages(spark, sf), ["input[type='text']", "div[class='ad']"], ["thth", "zuver"],
        keep=["page_id"]).drop("ord")


@query(rf"""
with m as (select page_id, {BARE} as html from pages),
d as (select page_id, lower(array_to_string({AD}, '')) as t from m)
select page_id, contains(t, 'thth') or contains(t, 'zuver') as flag from d
""")
def interaction_needed(spark, sf):
    return C.interaction_needed(
        pages(spark, sf), ["input[type='text']", "div[class='ad']"], ["thth", "zuver"], keep=["page_id"])


@query(rf"""
with m as (select page_id, {BARE} as html from pages)
select page_id, case when page_id < 100 then {ENTITIES.format("regexp_replace(regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1), '<[^>]*>', '', 'g')")} end as content
from m
""")
def text_by_id(spark, sf):
    marked = F.when(
        F.col("page_id") < 100, F.replace("html", F.lit('class="ad"'), F.lit('id="main-content"'))
    ).otherwise(F.col("html"))
    return pages(spark, sf, ["div"], marked).select(
        "page_id", D.text_by_id(F.col("dom"), "div", "main-content").alias("content"))


@query(rf"""
{DOMAIN_CTE.strip()},
k as (select page_id from pages qualify row_number() over (
  partition by regexp_replace(url, '[?#].*$', '') order by page_id desc) = 1),
m as (select page_id, {BARE} as html from pages join k using (page_id))
select d.domain, d.host, count(*) as n_pages, cast(sum(length({BODY})) as bigint) as n_chars
from m join d using (page_id) group by 1, 2
""")
def site_page_counts(spark, sf):
    return jobs.site_page_counts(
        table(spark, sf, "pages").select("page_id", "url", "html"),
        lambda df: registered_domain(df, "url", suffixes(spark), max_labels=2))


CAPTURE_PAGES = rf"""
with c as (select page_id, html, regexp_replace(url, '^https?://|[?#].*$', '', 'g') as urlkey,
    regexp_extract(url, '/(en|de|fr|es)/', 1) as l from pages),
k as (select page_id, html, urlkey, l from c qualify row_number() over (partition by urlkey order by page_id desc) = 1),
m as (select urlkey, {BARE} as html from k where l <> 'fr'),
t as (select urlkey, {ENTITIES.format("regexp_replace(html, '<[^>]*>', '', 'g')")} as t, {TITLE} as title from m)
select urlkey, md5({lines('t')}) as digest, title as url_metadata from t
"""


def members(spark, sf):
    """The pages as gzip records, ten to a file."""
    import gzip

    import pyarrow as pa

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        head = "WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"
        return pa.array([gzip.compress((head + t.as_py()).encode(), 1) for t in texts], pa.binary())

    key = F.regexp_replace("url", "^https?://|[?#].*$", "")
    file = F.floor(F.col("page_id") / 10)
    return table(spark, sf, "pages").select(
        "page_id", "url", key.alias("urlkey"), file.alias("filename"), pack("html").alias("member"))


def captured(source, *place):
    """Index rows of the records: French ones have status 404 and must take their key along."""
    number = F.lpad(F.col("page_id").cast("string"), 12, "0")
    return source.select(
        "urlkey", "url", number.alias("timestamp"), F.lit("text/html").alias("mime"),
        F.when(F.col("url").contains("/fr/"), "404").otherwise("200").alias("status"),
        F.lit("eng").alias("languages"), F.lit("UTF-8").alias("encoding"), "filename", *place)


@query(CAPTURE_PAGES)
def capture_pages(spark, sf):
    """Captures made of the pages, ten records in a file, the files as a table."""
    from pyspark.sql import Window

    source = materialize(members(spark, sf), "members")
    size = F.octet_length("member")
    before = Window.partitionBy("filename").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    captures = captured(source, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("string").alias("offset"),
                        size.cast("string").alias("length"))
    parts = F.sort_array(F.collect_list(F.struct("page_id", "member")))
    records = source.groupBy("filename").agg(F.aggregate(
        parts, F.lit(b""), lambda file, m: F.concat(file, m["member"])).alias("payload"))
    return jobs.capture_pages(captures, records, "filename").select(
        "urlkey", F.md5("html_parsed").alias("digest"), "url_metadata")


@query(CAPTURE_PAGES)
def capture_files(spark, sf):
    """The same through archive files: the ranges of the wanted records are sought in them."""
    root = fresh_path(spark, "archive")
    index = write_records(members(spark, sf), root, "filename", "page_id", "member")
    return jobs.capture_pages(captured(index, "offset", "length"), root).select(
        "urlkey", F.md5("html_parsed").alias("digest"), "url_metadata")


@query("""
select page_id, regexp_extract(url, '/(en|de|fr|es)/', 1) as crawl, md5(html) as digest from pages
where regexp_extract(url, '/(en|de|fr|es)/', 1) in ('de', 'es') and starts_with(url, 'https://')
""")
def record_scan(spark, sf):
    """Records by snapshot (here the language) and start of the address: both tests reach the index."""
    root, path = fresh_path(spark, "archive"), fresh_path(spark, "index")
    index = write_records(members(spark, sf), root, "filename", "page_id", "member")
    crawl = F.regexp_extract("url", "/(en|de|fr|es)/", 1)
    index.withColumn("crawl", crawl).write.partitionBy("crawl").parquet(path)
    found = read_records(spark, path, root).filter(
        F.col("crawl").isin("de", "es") & F.col("url").startswith("https://"))
    return read_bodies(found).select("page_id", "crawl", F.md5("html").alias("digest"))
