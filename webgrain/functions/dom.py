"""HTML as a nested column.

``shred`` is the one Python step: a linear scanner turns a page into flat lists
of nodes and text pieces. A node keeps the range ``[t0, t1)`` of text pieces below it, so a
page is stored once however deep it nests. Everything after that is JVM column work on the row.
"""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain.functions.markup import attributes, scan
from webgrain.functions.strings import clean_lines, keyword_form, strip
from webgrain.functions.urls import normalize_url, path, resolve
from webgrain.lookups import ABOUT_WORDS, HOME_PREFIX, REGION_WORD, TERMS_PATTERNS

DOM_SCHEMA = (
    "nodes array<struct<ord:int,end_ord:int,depth:int,tag:string,attrs:map<string,string>,"
    "string:string,t0:int,t1:int>>,texts array<string>"
)
_NODE = pa.struct([
    ("ord", pa.int32()), ("end_ord", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("string", pa.string()),
    ("t0", pa.int32()), ("t1", pa.int32()),
])
_DOM = pa.struct([("nodes", pa.list_(_NODE)), ("texts", pa.list_(pa.string()))])

# --- fixed values: HTML element kinds ---
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
}
_NOT_TEXT = {"script", "style", "template", "rt", "rp"}
_KEEP_SPACE = {"pre", "textarea"}
# ----------------------------------------


class _Elements:
    """Columns of all elements of a page; rows are only built for those that are asked for."""

    def __init__(self):
        self.tag, self.source, self.depth, self.t0, self.t1, self.end = [], [], [], [], [], []
        self.only = []  # single child: its text, or its number, or None if more


def read_page(html, tags=None):
    """One page as ``{nodes, texts}``; with ``tags`` only those nodes are returned.

    An end tag closes the nearest open element of its name and all inside it, and is ignored when
    none is open. Broken markup never fails: what can be read is kept.
    """
    if html is None:
        return None
    e, texts, stack, pending = _Elements(), [], [], []
    silent = verbatim = 0  # open elements without text / with kept blanks

    def add_child(child):
        if stack:
            top = stack[-1]
            e.only[top] = child if e.only[top] == () else None

    def flush():
        text = "".join(pending)
        pending.clear()
        if text:
            if not verbatim and not text.strip(" \n\t\f\r"):
                text = "\n" if "\n" in text else " "
            add_child(text)
            if not silent:
                texts.append(text)

    def close(upto):
        nonlocal silent, verbatim
        for i in stack[upto:]:
            e.end[i], e.t1[i] = len(e.tag), len(texts)
            silent -= e.tag[i] in _NOT_TEXT
            verbatim -= e.tag[i] in _KEEP_SPACE
        del stack[upto:]

    open_tags = {}  # name -> how many are open
    for kind, content, rest in scan(html):
        if kind in ("text", "raw"):
            pending.append(content)
            continue
        flush()
        if kind == "cdata":
            pending.append(content)
            flush()
        elif kind == "note":
            add_child(content)
        elif kind == "open":
            number = len(e.tag)
            add_child(number)
            for column, value in ((e.tag, content), (e.source, rest), (e.depth, len(stack)), (e.t0, len(texts)),
                                  (e.t1, 0), (e.end, 0), (e.only, ())):
                column.append(value)
            stack.append(number)
            open_tags[content] = open_tags.get(content, 0) + 1
            silent += content in _NOT_TEXT
            verbatim += content in _KEEP_SPACE
            if content in _VOID or rest.endswith("/"):
                open_tags[content] -= 1
                close(len(stack) - 1)
        elif open_tags.get(content):
            level = len(stack) - 1
            while e.tag[stack[level]] != content:
                open_tags[e.tag[stack[level]]] -= 1
                level -= 1
            open_tags[content] -= 1
            close(level)
    flush()
    close(0)
    for i in range(len(e.tag) - 1, -1, -1):  # children come after their parent
        child = e.only[i]
        if isinstance(child, int):
            e.only[i] = e.only[child]
    return {"texts": texts, "nodes": [
        {"ord": i, "end_ord": e.end[i], "depth": e.depth[i], "tag": e.tag[i],
         "attrs": list(attributes(e.source[i]).items()) if e.source[i] else [],
         "string": e.only[i] if isinstance(e.only[i], str) else None, "t0": e.t0[i], "t1": e.t1[i]}
        for i in range(len(e.tag)) if tags is None or e.tag[i] in tags]}


def shred(html: Column, tags=None) -> Column:
    """HTML column to a DOM column. Name the ``tags`` a query needs: fewer nodes travel."""
    wanted = None if tags is None else frozenset(tags)

    @F.arrow_udf(f"struct<{DOM_SCHEMA}>".replace("nodes array", "nodes:array")
                 .replace(",texts array", ",texts:array"))
    def _shred(pages: pa.Array) -> pa.Array:
        return pa.array([read_page(p.as_py(), wanted) for p in pages], type=_DOM)

    # a page is parsed once: the optimizer may not repeat the step to push a filter below it
    return _shred.asNondeterministic()(html)


# --- columns over a shredded page -----------------------------------------------------------


def nodes_of(dom: Column, *tags: str) -> Column:
    return F.filter(dom["nodes"], lambda n: n["tag"].isin(*tags))


def attr(node: Column, name: str) -> Column:
    """Attribute value, null when absent."""
    return F.element_at(node["attrs"], F.lit(name))


def node_texts(dom: Column, node: Column) -> Column:
    return F.slice(dom["texts"], node["t0"] + 1, node["t1"] - node["t0"])


def node_text(dom: Column, node: Column) -> Column:
    """All text below a node, nothing in between."""
    return F.array_join(node_texts(dom, node), "")


def node_stripped(dom: Column, node: Column, separator: str = "") -> Column:
    """Text pieces below a node, each stripped, empty ones dropped."""
    pieces = F.transform(node_texts(dom, node), strip)
    return F.array_join(F.filter(pieces, lambda t: t != ""), separator)


def first_node(dom: Column, tag: str) -> Column:
    return F.get(nodes_of(dom, tag), F.lit(0))


def title(dom: Column) -> Column:
    return let(first_node(dom, "title"), lambda n: node_text(dom, n))


def page_text(dom: Column) -> Column:
    """Whole visible text (title included), line-cleaned."""
    return clean_lines(F.array_join(dom["texts"], ""))


def has_body(dom: Column) -> Column:
    return F.exists(dom["nodes"], lambda n: n["tag"] == "body")


def body_text(dom: Column) -> Column:
    """Stripped text pieces of the body, one per line; null without a body."""
    return let(first_node(dom, "body"), lambda n: node_stripped(dom, n, "\n"))


def url_metadata(dom: Column, url: Column, fallback: bool = True) -> Column:
    """``title. description``; the title alone without a description (null if not
    ``fallback``); home pages get a prefix."""
    described = F.filter(nodes_of(dom, "meta"), lambda n: attr(n, "name") == "description")
    description = attr(F.get(described, F.lit(0)), "content")
    name = title(dom)
    if fallback:
        name = F.concat(F.when(path(url) == "/", F.lit(HOME_PREFIX)).otherwise(F.lit("")), name)
    both = F.struct(name.alias("name"), description.alias("description"))

    def join(x):
        full = F.concat(x["name"], F.lit(". "), x["description"])
        return F.coalesce(full, x["name"]) if fallback else full

    return let(both, join)


def anchors(dom: Column) -> Column:
    return F.filter(nodes_of(dom, "a"), lambda n: attr(n, "href").isNotNull())


def about_link(dom: Column, base: Column, words=tuple(ABOUT_WORDS)) -> Column:
    """First link whose text is one of the words or whose address holds one."""

    listed = F.array(*[F.lit(w) for w in words])

    def is_about(n):
        in_address = let(
            keyword_form(attr(n, "href"), slashes=True),
            lambda address: F.exists(listed, lambda word: F.contains(address, word)),
        )
        return keyword_form(node_text(dom, n)).isin(*words) | in_address

    return resolve(base, attr(F.get(F.filter(anchors(dom), is_about), F.lit(0)), "href"))


def region_link(dom: Column, base: Column, word: str = REGION_WORD) -> Column:
    """First link whose lower-case text holds the word."""
    hits = F.filter(
        anchors(dom), lambda n: F.contains(F.lower(strip(node_text(dom, n))), F.lit(word))
    )
    return resolve(base, attr(F.get(hits, F.lit(0)), "href"))


def terms_link(dom: Column, base: Column, patterns=tuple(TERMS_PATTERNS)) -> Column:
    """First terms link: pattern by pattern, links by their text before links by address.

    Relative addresses are put after the normalised site with the double slash kept.
    """

    def by_text(links, p):
        return F.filter(links, lambda n: n["string"].rlike(f"(?iu){p}"))

    def by_address(links, p):
        return F.filter(links, lambda n: attr(n, "href").rlike(f"(?iu){p.replace(' ', '-')}"))

    def first_href(links):
        passes = [found(links, p) for p in patterns for found in (by_text, by_address)]
        return F.coalesce(*[attr(F.get(hits, F.lit(0)), "href") for hits in passes])

    def absolute(href):
        tail = F.regexp_replace(href, "^/+", "")
        return F.when(href.startswith("http"), href).otherwise(
            F.concat(normalize_url(base), F.lit("/"), tail)
        )

    return let(let(anchors(dom), first_href), absolute)


def text_by_id(dom: Column, tag: str, node_id: str) -> Column:
    """Text of the first such element, null when there is none."""
    hits = F.filter(nodes_of(dom, tag), lambda n: attr(n, "id") == node_id)
    return let(F.get(hits, F.lit(0)), lambda n: node_text(dom, n))


def has_class(node: Column, name: str) -> Column:
    return F.array_contains(F.split(attr(node, "class"), r"\s+"), name)


def matches_selector(node: Column, selector: str) -> Column:
    """One of the closed selector forms: ``.class``, ``#id``, ``tag``, ``[a='v']``,
    ``[a*='v']``, each optionally after a tag."""
    tag, rest = selector, ""
    for mark in ".#[":
        if mark in selector:
            tag, rest = selector.split(mark, 1)[0], selector[selector.index(mark):]
            break
    hit = node["tag"] == tag if tag else F.lit(True)
    if rest.startswith("."):
        hit = hit & F.coalesce(has_class(node, rest[1:]), F.lit(False))
    elif rest.startswith("#"):
        hit = hit & F.coalesce(attr(node, "id") == rest[1:], F.lit(False))
    elif rest:
        name, value = rest[1:-1].split("=", 1)
        value = value.strip("'\"")
        if name.endswith("*"):
            test = F.contains(attr(node, name[:-1]), F.lit(value))
        else:
            test = attr(node, name) == value
        hit = hit & F.coalesce(test, F.lit(False))
    return hit
