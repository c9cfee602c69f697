"""Operators over shredded pages. All are map-only: a page is handled in its own row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain import lookups as L
from webgrain.functions import dom as D
from webgrain.functions.binding import let
from webgrain.functions.strings import strip
from webgrain.functions.urls import hostname, resolve


def shred(df: DataFrame, html: str = "html", tags=None, name: str = "dom") -> DataFrame:
    """Replace the html column by its DOM."""
    return df.withColumn(name, D.shred(F.col(html), tags)).drop(html)


def page_items(df: DataFrame, url: str = "url", dom: str = "dom") -> DataFrame:
    """(url, title, body); pages without a body are dropped."""
    d = F.col(dom)
    return df.filter(D.has_body(d)).select(
        url, D.title(d).alias("title"), D.body_text(d).alias("body"))


def link_edges(df: DataFrame, domains: list[str] | None = None, keep: list[str] = (),
               url: str = "url", dom: str = "dom", patterns: list[str] | None = None) -> DataFrame:
    """Edge table (src, ord, dst): links of a page resolved, each address once, in page order;
    with ``domains`` only hosts equal to or under one of them, with ``patterns`` only addresses in
    which one of these regular expressions is found."""
    targets = F.array_distinct(
        F.transform(D.anchors(F.col(dom)), lambda n: resolve(F.col(url), D.attr(n, "href")))
    )
    edges = df.select(*keep, F.col(url).alias("src"), F.posexplode(targets).alias("ord", "dst"))
    if patterns is not None:
        allowed = F.lit(False)
        for p in patterns:
            allowed = allowed | F.col("dst").rlike(p)
        edges = edges.filter(allowed)
    if domains is None:
        return edges
    host = hostname(F.col("dst"))
    inside = F.lit(False)
    for d in domains:
        inside = inside | (host == d) | host.endswith("." + d)
    return edges.filter(inside)


def first_links(df: DataFrame, css_class: str | None, n: int = 5, prefix: str = "",
                keep: list[str] = (), dom: str = "dom") -> DataFrame:
    """(ord, link): first n links of a page (of one CSS class), with a prefix."""
    links = D.anchors(F.col(dom))
    if css_class is not None:
        links = F.filter(links, lambda a: F.coalesce(D.has_class(a, css_class), F.lit(False)))
    hrefs = F.transform(F.slice(links, 1, n), lambda a: F.concat(F.lit(prefix), D.attr(a, "href")))
    return df.select(*keep, F.posexplode(hrefs).alias("ord", "link"))


def _first_word(text: Column, listed: Column) -> Column:
    return F.get(F.filter(listed, lambda w: F.contains(text, w)), F.lit(0))


def _pieces(d: Column) -> Column:
    """The text pieces of a page, stripped and in lower case: done once, elements are ranges of them."""
    return F.transform(d["texts"], lambda t: F.lower(strip(t)))


def _present(pieces: Column, keywords) -> Column:
    """The keywords that the page holds at all, in their order: elements need not be asked for others."""
    listed = F.array(*[F.lit(w) for w in keywords]).cast("array<string>")
    return let(F.array_join(pieces, ""), lambda page: F.filter(listed, lambda w: F.contains(page, w)))


def popup_evidence(df: DataFrame, tags=tuple(L.POPUP_TAGS), keywords=tuple(L.POPUP_WORDS),
                   selectors=tuple(L.POPUP_SELECTORS), keep: list[str] = (),
                   dom: str = "dom") -> DataFrame:
    """(flag, kind, tag, hit): first evidence of a pop-up. Tags in order, then page order, then
    keywords in order; after that the selectors in order."""
    d = F.col(dom)
    evidence = "struct<kind:string,tag:string,hit:string>"

    def by_text(tag, pieces, present):
        texts = F.transform(D.nodes_of(d, tag), lambda n: F.array_join(
            F.slice(pieces, n["t0"] + 1, n["t1"] - n["t0"]), ""))
        words = F.filter(F.transform(texts, lambda t: _first_word(t, present)),
                         lambda w: w.isNotNull())
        return F.when(F.size(words) > 0,
                      F.struct(F.lit("text"), F.lit(tag), F.get(words, F.lit(0))).cast(evidence))

    def in_texts(pieces):
        return let(_present(pieces, keywords), lambda p: F.when(F.size(p) > 0, F.coalesce(*[by_text(t, pieces, p) for t in tags])))

    def by_selector(selector):
        node = F.get(F.filter(d["nodes"], lambda n: D.matches_selector(n, selector)), F.lit(0))
        return F.when(node.isNotNull(),
                      F.struct(F.lit("selector"), node["tag"], F.lit(selector)).cast(evidence))

    found = [let(_pieces(d), in_texts)] if tags else []
    first = F.coalesce(F.lit(None).cast(evidence), *found, *[by_selector(s) for s in selectors])
    return df.withColumn("_e", first).select(
        *keep, F.col("_e").isNotNull().alias("flag"), "_e.kind", "_e.tag", "_e.hit"
    )


def role_elements(df: DataFrame, roles=tuple(L.ELEMENT_ROLES), keep: list[str] = (),
                  attribute: str = "role", dom: str = "dom") -> DataFrame:
    """(role, ord, text): elements per role in the given order, then in page order."""
    d = F.col(dom)

    def rows(role):
        return F.transform(
            F.filter(d["nodes"], lambda n: D.attr(n, attribute) == role),
            lambda n: F.struct(
                F.lit(role).alias("role"), n["ord"].alias("ord"),
                strip(D.node_text(d, n)).alias("text"),
            ),
        )

    return df.select(*keep, F.inline(F.concat(*[rows(r) for r in roles])))


def interaction_evidence(df: DataFrame, selectors=tuple(L.INTERACTION_SELECTORS),
                         keywords=tuple(L.INTERACTION_WORDS), keep: list[str] = (),
                         dom: str = "dom") -> DataFrame:
    """(selector, ord, tag, text): elements of each selector whose text holds a keyword."""
    return df.select(*keep, F.inline(_interactive(F.col(dom), selectors, keywords)))


def interaction_needed(df: DataFrame, selectors=tuple(L.INTERACTION_SELECTORS),
                       keywords=tuple(L.INTERACTION_WORDS), keep: list[str] = (), dom: str = "dom") -> DataFrame:
    """(flag): whether a page has such an element; a row per page."""
    return df.select(*keep, (F.size(_interactive(F.col(dom), selectors, keywords)) > 0).alias("flag"))


def _interactive(d: Column, selectors, keywords) -> Column:
    """Elements of the selectors with a keyword; pieces stripped and words of the page found once, as above."""
    found = "array<struct<selector:string,ord:int,tag:string,text:string>>"

    def rows(selector, pieces, present):
        nodes = F.filter(d["nodes"], lambda n: D.matches_selector(n, selector))
        texts = F.transform(nodes, lambda n: F.struct(
            F.lit(selector).alias("selector"), n["ord"].cast("int").alias("ord"), n["tag"].alias("tag"),
            F.array_join(F.slice(pieces, n["t0"] + 1, n["t1"] - n["t0"]), "").alias("text")))
        return F.filter(texts, lambda r: _first_word(r["text"], present).isNotNull())

    none = F.array().cast(found)
    return let(_pieces(d), lambda pieces: let(_present(pieces, keywords), lambda p: F.when(
        F.size(p) > 0, F.concat(none, *[rows(s, pieces, p) for s in selectors])).otherwise(none)))
