"""robots.txt: one row per host, parsed inside the row, joined once to the pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain.functions.strings import split_lines, strip
from webgrain.functions.urls import path_and_rest, unquote

_KINDS = ("user-agent", "disallow", "allow", "crawl-delay", "request-rate")
_RULE = "struct<line:int,group:int,kind:string,value:string>"


def parse_rules(text: Column) -> Column:
    """Directives as ``array<struct<line, group, kind, value>>``.

    A group is a run of agent lines and the lines after it. It ends at a blank line or at the
    next agent line; agents followed by a blank line before any rule are forgotten (their group
    has no rules). Rules outside a group are skipped.
    """

    def directive(line, i):
        body = strip(F.regexp_replace(line, "#.*$", ""))
        kind = F.lower(strip(F.substring_index(body, ":", 1)))
        return F.struct(
            i.alias("line"),
            F.when(line == "", F.lit("")).when(F.contains(body, F.lit(":")), kind).alias("kind"),
            unquote(strip(F.regexp_replace(body, "^[^:]*:", ""))).alias("value"),
        )

    lines = F.filter(
        F.transform(split_lines(text), directive), lambda d: d["kind"].isin("", *_KINDS)
    )

    def step(acc, d):
        # phase 0: no group open, 1: reading agents, 2: reading rules
        phase, group, kind = acc["phase"], acc["group"], d["kind"]
        starts = ((kind == "") & (phase > 0)) | ((kind == "user-agent") & (phase == 2))
        number = F.when(starts, group + 1).otherwise(group)
        kept = (kind == "user-agent") | ((kind != "") & (phase > 0))
        row = F.struct(d["line"], number.alias("group"), kind, d["value"]).cast(_RULE)
        return F.struct(
            F.when(kind == "user-agent", 1).when(kind == "", 0)
            .when(phase > 0, 2).otherwise(0).alias("phase"),
            number.alias("group"),
            F.when(kept, F.concat(acc["rules"], F.array(row))).otherwise(acc["rules"]).alias("rules"),
        )

    start = F.struct(
        F.lit(0).alias("phase"), F.lit(0).alias("group"),
        F.array().cast(f"array<{_RULE}>").alias("rules"),
    )
    return F.aggregate(lines, start, step, lambda acc: acc["rules"])


def robots_rules(df: DataFrame, host: str, text: str) -> DataFrame:
    """One row per directive."""
    return df.select(host, F.inline(parse_rules(F.col(text))))


def agent_rules(rules: Column, agent: str) -> Column:
    """Directives of the group that speaks to the agent: the first group that names it, else
    the first ``*`` group. Groups without rules do not count."""
    token = F.lit(agent.split("/")[0].lower())

    def groups(rs, test):
        return F.transform(F.filter(rs, test), lambda r: r["group"])

    def pick(rs):
        sets = F.struct(
            groups(rs, lambda r: r["kind"] != "user-agent").alias("ruled"),
            groups(rs, lambda r: (r["kind"] == "user-agent") & (r["value"] == "*")).alias("star"),
            groups(rs, lambda r: (r["kind"] == "user-agent")
                   & F.contains(token, F.lower(r["value"]))).alias("named"),
        )
        chosen = let(sets, lambda s: F.coalesce(
            F.array_min(F.array_except(F.array_intersect(s["named"], s["ruled"]), s["star"])),
            F.array_min(F.array_intersect(s["star"], s["ruled"])),
        ))
        return let(chosen, lambda c: F.filter(rs, lambda r: r["group"] == c))

    return let(rules, pick)


def _tidy(url: Column) -> Column:
    return F.regexp_replace(url, r"\?(?=#|$)|#$", "")


def allows(rules: Column, url: Column) -> Column:
    """Decision of the first rule whose path starts the URL's path; no match allows."""
    path = let(_tidy(path_and_rest(unquote(url))),
               lambda p: F.when(p == "", F.lit("/")).otherwise(p))

    def decide(target):
        hits = F.filter(
            rules,
            lambda r: r["kind"].isin("allow", "disallow") & let(
                _tidy(r["value"]), lambda p: (p == "*") | target.startswith(p)),
        )
        return F.get(hits, F.lit(0))

    first = let(path, decide)
    return let(first, lambda r: F.coalesce(
        (r["kind"] == "allow") | (r["value"] == ""), F.lit(True)))


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str, url: str = "url",
                   host: str = "host", text: str = "robots_txt") -> DataFrame:
    """Add ``allowed``. ``robots`` holds one text per host; hosts without one allow all."""
    chosen = robots.select(host, agent_rules(parse_rules(F.col(text)), agent).alias("_rules"))
    return urls.join(chosen, host, "left").withColumn(
        "allowed", F.coalesce(allows(F.col("_rules"), F.col(url)), F.lit(True))
    ).drop("_rules")


def _last_value(rules, kind, shape):
    good = F.filter(rules, lambda r: (r["kind"] == kind) & r["value"].rlike(shape))
    return F.when(F.size(good) > 0, F.element_at(good, -1)["value"])


def crawl_delay(rules: Column) -> Column:
    """Seconds from the agent's rules; values that are not digits do not count."""
    return _last_value(rules, "crawl-delay", r"^\d+$").try_cast("int")


def request_rate(rules: Column) -> Column:
    """``struct<requests, seconds>`` from ``n/s``."""
    value = _last_value(rules, "request-rate", r"^\s*\d+\s*/\s*\d+\s*$")
    return let(F.split(value, "/"), lambda parts: F.when(
        parts.isNotNull(),
        F.struct(
            strip(parts[0]).try_cast("int").alias("requests"),
            strip(parts[1]).try_cast("int").alias("seconds"),
        ),
    ))


def visit_time(text: Column) -> Column:
    """Bounds of the first ``Visit-time`` line, an optional colon allowed; null when malformed."""
    lines = F.filter(split_lines(text), lambda line: line.startswith("Visit-time"))

    def bound(line, i):
        return F.regexp_extract(line, r"^Visit-time\s*:?\s*(\d+)\s*-\s*(\d+)\s*$", i).try_cast("int")

    return let(
        F.get(lines, F.lit(0)),
        lambda line: F.struct(bound(line, 1).alias("start"), bound(line, 2).alias("end")),
    )


def crawl_directives(robots: DataFrame, agent: str, host: str = "host", text: str = "robots_txt") -> DataFrame:
    """One row per host: delay, requests per seconds and visit hours that hold for the agent; null
    where nothing (or nothing well formed) is said."""
    rows = robots.select(
        host, agent_rules(parse_rules(F.col(text)), agent).alias("_rules"), visit_time(F.col(text)).alias("_time"))
    rate = request_rate(F.col("_rules"))
    return rows.select(
        host, crawl_delay(F.col("_rules")).alias("delay"), rate["requests"].alias("requests"),
        rate["seconds"].alias("seconds"), F.col("_time.start").alias("visit_start"), F.col("_time.end").alias("visit_end"))
