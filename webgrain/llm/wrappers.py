"""Main text of web pages by wrapper inference.

The pages of a host share a template. A page is read as a stream of structural tags and text slots;
runs of equal groups fold into one repeated group. The streams of a host are aligned one after the
other: where they differ, the odd part becomes an optional group, so that a union-free regular
expression, the wrapper, covers all pages of the host. Its text slots are then rated over all
pages, and those of the main content are read out.
"""

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.functions.markup import attributes, scan
from webgrain.llm.common import packed, stored, unpacked

# Elements that set text apart from what stands before and after.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu "
    "nav noscript ol option p pre search section select summary table tbody td template textarea tfoot th "
    "thead title tr ul".split())
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that never hold main text.
OUTSIDE = frozenset(
    "head title nav footer aside form button select option label legend fieldset textarea menu dialog "
    "noscript template search script style svg canvas object iframe audio video".split())
# Words in class, id or role that name other parts of a page.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments "
    "commentlist complementary contentinfo cookie cookies consent disqus discussion footer form gdpr header "
    "login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination popup promo promoted promotion recommended related replies reply respond search share "
    "sharing sidebar signup site-header social sponsor sponsored subscribe subscription tagcloud toolbar "
    "widget widgets".split())
# How class words begin that tell the state of an element.
STATES = frozenset("has have with without no not is show hide hides enable enabled disable disabled".split())
# An open element of the right side ends where one of the left side starts.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"}, "tbody": {"tr", "td", "th", "thead"},
}
_CLOSES_P = BLOCKS - {"button", "label", "option", "legend", "select", "textarea", "noscript", "template", "title"}
LONGEST_PERIOD = 12  # of a repeated group, in tokens


def _names_outside(word: str) -> bool:
    """Whether a class word names another part of a page. "has-sidebar" or "no-comments" tell of the
    element what it holds or lacks, not what it is."""
    parts = re.split("[-_]+", word)
    return word in OUTSIDE_WORDS or parts[0] not in STATES and any(p in OUTSIDE_WORDS for p in parts)


def _label(tag: str, attrs: str) -> str:
    """The element name; with "!" where the element is not main content."""
    if tag in OUTSIDE:
        return f"{tag}!"
    if attrs and tag not in ("html", "body"):
        named = attributes(attrs)
        if "hidden" in named or named.get("aria-hidden") == "true":
            return f"{tag}!"
        words = " ".join(named.get(k, "") for k in ("class", "id", "role")).lower()
        if tag not in ("article", "main") and any(map(_names_outside, words.split())):
            return f"{tag}!"
    return tag


def read_page(source: str) -> tuple[list[tuple[str, str]], list]:
    """The text blocks as (path of labels, text) and the token stream with folded repeats.

    Open elements end by their end tag, by the tags that imply it, or with the page. An end tag
    that nothing waits for is passed over.
    """
    stack: list[tuple[str, str]] = []
    blocks, tokens, pieces = [], [], []

    def flush():
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            blocks.append(("/".join(dict.fromkeys(x for _, x in stack)), text))
            tokens.append("#")

    def close(k):
        flush()
        while len(stack) > k:
            tokens.append(f"</{stack.pop()[1]}>")

    for kind, name, rest in scan(source):
        if kind == "text":
            pieces.append(name)
        elif kind == "open":
            if name == "br":
                pieces.append(" ")
            if name not in BLOCKS and name not in OUTSIDE:
                continue
            flush()
            ended = {"p"} if name in _CLOSES_P else set()
            ended |= ENDS.get(name, set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ended:
                    close(k)
                    break
                if stack[k][0] in ("table", "ul", "ol", "dl", "article", "section", "div", "button"):
                    break
            if name in VOID:
                continue
            label = _label(name, rest)
            stack.append((name, label))
            tokens.append(f"<{label}>")
        elif kind == "close":
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in ("p", "li", "b") and stack[k][0] in ("article", "table", "body"):
                    break
    close(0)
    return blocks, fold(tokens)


def _closed(group: list) -> bool:
    depth = 0
    for x in group:
        if isinstance(x, str) and x != "#":
            depth += -1 if x[1] == "/" else 1
            if depth < 0:
                return False
    return depth == 0


def fold(tokens: list) -> list:
    """Runs of equal groups as one repeated group ["+", group], short groups first. A group closes
    what it opens."""
    for period in range(1, LONGEST_PERIOD + 1):
        out, i, n = [], 0, len(tokens)
        while i < n:
            group = tokens[i:i + period]
            k = i + period
            if tokens[k:k + period] == group and _closed(group):
                while tokens[k:k + period] == group:
                    k += period
            if k > i + period:
                out.append(group[0] if period == 1 and group[0][0] == "+" else ["+", group])
                i = k
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


def _placed(items: list) -> list[str]:
    """Tokens with the open elements around them: only tokens of one place can be aligned."""
    out, stack = [], []
    for x in items:
        token = x[1][0] if x[0] == "?" and len(x[1]) == 1 else x
        if isinstance(token, str) and token.startswith("</") and token[2:-1] in stack:
            while stack.pop() != token[2:-1]:
                pass
        out.append("/".join(stack) + json.dumps(token))
        if isinstance(token, str) and token[0] == "<" and token[1] != "/":
            stack.append(token[1:-1])
    return out


def align(a: list, b: list) -> list:
    """The wrapper that covers both: common tokens stay, parts of one side only become optional
    groups ["?", group]; two repeated groups at the same place are aligned inside."""
    if a == b:
        return a
    keys = [_placed(side) for side in (a, b)]
    out = []

    def optional(part):
        for x in part:
            out.append(x if x[0] == "?" else ["?", [x]])

    for op, i, j, k, m in SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(a[i:j], b[k:m]):
                out.append(x if x[0] == "?" else y)  # once optional, always optional
        elif op == "replace" and j - i == m - k and all(
                x[0] == y[0] == "+" and x[1][0] == y[1][0] for x, y in zip(a[i:j], b[k:m])):
            out.extend(["+", align(x[1], y[1])] for x, y in zip(a[i:j], b[k:m]))
        else:
            optional(a[i:j])
            optional(b[k:m])
    merged = []
    for x in out:  # the same optional part twice in a row is one that may repeat
        if merged and x == merged[-1] and x[0] == "?" and _closed(x[1]):
            merged[-1] = ["?", [["+", x[1]]]]
        elif not (merged and x[0] == "?" and merged[-1] == ["?", [["+", x[1]]]]):
            merged.append(x)
    return merged


def expression(wrapper: list) -> str:
    """The wrapper as a readable union-free regular expression."""
    return " ".join(x if isinstance(x, str) else f"({expression(x[1])}){x[0]}" for x in wrapper)


def slots(wrapper: list) -> list[str]:
    """Paths of the text slots, in order of their first place."""
    found, stack = {}, []

    def walk(items):
        for x in items:
            if not isinstance(x, str):
                walk(x[1])
            elif x == "#":
                found["/".join(dict.fromkeys(stack))] = True
            elif x.startswith("</"):
                if x[2:-1] in stack:
                    while stack.pop() != x[2:-1]:
                        pass
            else:
                stack.append(x[1:-1])

    walk(wrapper)
    return list(found)


def _merge_round(streams: DataFrame, buckets: int) -> DataFrame:
    """One wrapper per host and bucket. A group holds the distinct streams of one bucket only."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        streams = sorted(set(rows["stream"]), key=lambda s: (len(s), s))
        wrapper = json.loads(streams[0])
        for s in streams[1:]:
            wrapper = align(wrapper, json.loads(s))
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "stream": [json.dumps(wrapper, ensure_ascii=False)]})

    return (
        streams.withColumn("_bucket", F.pmod(F.xxhash64("stream"), F.lit(buckets)))
        .groupBy("host", "_bucket").applyInPandas(merged, "host string, stream string"))


def read_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The columns of ``pages`` without the markup in ``_row``, and host, blocks, stream."""
    keep = [c for c in pages.columns if c != html]
    kind = "blocks array<struct<path:string,text:string>>, stream string"

    @F.pandas_udf(kind)
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            rows = []
            for source in column:
                blocks, stream = read_page(source or "")
                rows.append(([{"path": p, "text": t} for p, t in blocks], json.dumps(stream, ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["blocks", "stream"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(packed(keep), host.alias("host"), parsed(F.col(html)).alias("_p")).select("_row", "host", "_p.*")


def infer(read: DataFrame) -> DataFrame:
    """(host, wrapper) from all pages of ``read``: equal streams are merged first, the rest in three
    rounds of shrinking buckets."""
    streams = read.select("host", "stream").distinct()
    for buckets in (1024, 32, 1):
        streams = _merge_round(streams, buckets)
    return streams.withColumnRenamed("stream", "wrapper")


def content_slots(read: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, content): the paths of the slots of the main content, for three layouts that the pages of a
    host may have: those in articles, those in a main element, and those of pages without either.

    Slots below elements that are not main content are out. Without article and main element the
    content is the deepest element that holds most of the slots' text over all pages; there, a slot
    with the same text on every page (three at least) belongs to the template.
    """
    text = F.col("b.text")
    rated = (
        read.select("host", F.explode("blocks").alias("b"))
        .groupBy("host", F.col("b.path").alias("path"))
        .agg(F.sum(F.length(text)).alias("chars"), F.count("*").alias("times"),
             (F.min(F.xxhash64(text)) == F.max(F.xxhash64(text))).alias("same"))
        .groupBy("host").agg(F.collect_list(F.struct("path", "chars", "times", "same")).alias("rated")))

    @F.pandas_udf("array<array<string>>")
    def chosen(wrapper: pd.Series, rated: pd.Series) -> pd.Series:
        return pd.Series([choose(json.loads(w), r if r is not None else []) for w, r in zip(wrapper, rated)])

    return wrappers.join(rated, "host", "left").select("host", "wrapper", chosen("wrapper", "rated").alias("content"))


def choose(wrapper: list, rated) -> list[list[str]]:
    facts = {r["path"]: r for r in rated}
    found = [s for s in slots(wrapper) if s in facts]
    inner = [s for s in found if not any(x.endswith("!") for x in s.split("/"))]
    # of an article's own header only the headings are text of the article
    inner = [s for s in inner if not re.search(r"(^|/)header(/|$)", s) or re.search("(article|main)/.*header/.*h[1-6]$|(article|main)/header/h[1-6]$", s)]
    in_article = [s for s in inner if "article" in s.split("/")]
    in_main = [s for s in inner if "main" in s.split("/")]
    inner = [s for s in inner if s not in in_article and s not in in_main]
    total = sum(facts[s]["chars"] for s in inner)
    prefix: list[str] = []
    while total:
        share = {}
        for s in inner:
            parts = s.split("/")
            if parts[:len(prefix)] == prefix and len(parts) > len(prefix) + 1:
                share[parts[len(prefix)]] = share.get(parts[len(prefix)], 0) + facts[s]["chars"]
        best = max(share, key=share.get, default=None)
        if best is None or 2 * share[best] <= total:
            break
        prefix.append(best)
    inside = [s for s in inner if s.split("/")[:len(prefix)] == prefix]
    varied = [s for s in inside if not (facts[s]["same"] and facts[s]["times"] >= 3)]
    return [in_article, in_main, varied or inside]


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The columns of ``pages`` without the markup, and text and n_chars (code points).

    Null or empty markup and pages without main content give an empty text; a null url belongs to
    the host "". Pages are never cut. Repeated rows and ties give equal texts; an empty table gives
    an empty result; columns named text or n_chars are replaced.

    Pages are read once, into a stored table of blocks. A host's template is small (distinct token
    streams), so a host with a third of all pages costs no more in the inference than any other;
    its pages are joined to their wrapper by a join that can be split.
    """
    read = stored(read_pages(pages, html, url), "pages")
    # stored, so that its size is known: few hosts are broadcast by Spark's own limit
    slots_of = stored(content_slots(read, infer(read)).select("host", "content"), "slots")
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    # the first layout of which the page has a block
    layouts = F.transform("content", lambda paths: F.filter("blocks", lambda b: F.array_contains(paths, b["path"])))
    own = F.get(F.filter(layouts, lambda found: F.size(found) > 0), F.lit(0))
    text = F.array_join(F.transform(own, lambda b: b["text"]), " ")
    return (
        read.drop("stream").join(slots_of, "host", "left")
        .select(*unpacked(keep), F.coalesce(text, F.lit("")).alias("text"))
        .withColumn("n_chars", F.length("text").cast("long")))
