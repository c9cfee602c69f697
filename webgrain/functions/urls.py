"""URL functions: Column in, Column out. Malformed input gives empty parts, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgrain.functions.binding import let

_SCHEME = r"[a-zA-Z][a-zA-Z0-9+.-]*"
_HEAD = rf"^(?:{_SCHEME}:)?(?://[^/?#]*)?"


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, rf"^({_SCHEME}):", 1))


def netloc(c: Column) -> Column:
    """Authority with user and port, empty when there is none."""
    return F.regexp_extract(c, rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def hostname(c: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(c), r"^.*@", ""), r":\d*$", ""))


def _full_path(c: Column) -> Column:
    return F.regexp_extract(c, rf"{_HEAD}([^?#]*)", 1)


def path(c: Column) -> Column:
    """Path without the parameters (``;x``) of its last segment."""
    return F.regexp_replace(_full_path(c), r";[^/]*$", "")


def path_and_rest(c: Column) -> Column:
    """Everything after the authority: path, query and fragment."""
    return F.regexp_replace(c, _HEAD, "")


def unquote(c: Column) -> Column:
    """Percent-decode; ``+`` and malformed escapes stay as they are."""
    plain = F.replace(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plain), c)


def normalize_url(c: Column) -> Column:
    """Add ``http://`` unless it starts with ``http``, and a closing slash."""
    full = F.when(c.startswith("http"), c).otherwise(F.concat(F.lit("http://"), c))
    return F.when(full.endswith("/"), full).otherwise(F.concat(full, F.lit("/")))


def robots_url(c: Column) -> Column:
    return F.concat(scheme(c), F.lit("://"), netloc(c), F.lit("/robots.txt"))


def depth(c: Column) -> Column:
    """Number of slashes less the two of ``://``."""
    return F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit(""))) - 2


def _squash_dots(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in path segments and join them again."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segments, -1)
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` seen from ``base`` (RFC 3986 rules)."""
    parts = F.struct(
        base.alias("base"),
        # an empty authority counts for nothing
        F.regexp_replace(href, r"^//(?=[/?#]|$)", "").alias("href"),
        F.concat(scheme(base), F.lit("://"), netloc(base)).alias("site"),
    )
    return let(parts, lambda p: _resolve(p["base"], p["href"], p["site"]))


def _resolve(base: Column, href: Column, site: Column) -> Column:
    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_rest = F.regexp_replace(F.regexp_extract(href, r"^[^?#]*(.*)$", 1), r"\?(?=#|$)|#$", "")
    dotted = href.rlike(r"^[^?#]*(?<![^/])\.\.?([/?#]|$)")
    rooted = F.when(dotted, _squash_dots(F.split(ref_path, "/", -1))).otherwise(ref_path)
    return (
        F.when(href == "", base)
        .when(href.rlike(rf"^{_SCHEME}:"), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, rooted, ref_rest))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), ref_rest))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), ref_rest))
        .otherwise(F.concat(site, let(_segments(base, ref_path), _squash_dots), ref_rest))
    )


def _segments(base: Column, ref_path: Column) -> Column:
    """Folder of the base and the relative path, without empty segments in between."""

    def combine(p):
        folder = F.when(p["path"] == "", F.array(F.lit(""))).otherwise(
            F.slice(p["folder"], 1, F.greatest(F.size(p["folder"]) - 1, F.lit(1)))
        )
        return F.concat(folder, p["ref"])

    def tidy(joined):
        inner = F.slice(joined, 2, F.greatest(F.size(joined) - 2, F.lit(0)))
        return F.concat(
            F.slice(joined, 1, 1), F.filter(inner, lambda s: s != ""), F.slice(joined, -1, 1))

    base_path = _full_path(base)
    parts = F.struct(
        base_path.alias("path"),
        F.split(F.regexp_replace(base_path, r"[^/]*$", ""), "/", -1).alias("folder"),
        F.split(ref_path, "/", -1).alias("ref"),
    )
    return let(let(parts, combine), tidy)
