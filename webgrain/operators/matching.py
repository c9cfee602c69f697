"""Approximate string matching as equi-joins.

One edit: both sides list what is left when one character is blanked out (a substitution) or dropped
on either side, with the number of drops. Every pair with a common key is a match.

More edits, by the pigeonhole principle: a term is cut into k + 1 segments, and k edits leave one of
them whole. So the catalog has k + 1 keys per term (length, number of the segment, its text), and a
query is cut at the places where such a segment can stand: of the shifts up to k only those that no
other segment makes needless, a number that depends on k alone. Candidates are verified by their
distance. A segment that too many terms share (a common prefix) is no key; the terms that hold one
are matched by the keys that spell out all k edits, which never meet without being a match.

Repeated terms are matched once and spread to their rows afterwards.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.plans.scale import local_table, materialize, top_n_per_key


def _span(first: Column, last: Column) -> Column:
    """first..last, empty when last comes before first."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


# stands for a blanked character; terms that hold it themselves only cost extra checks
_BLANK = "\x00"


def _edited(level: Column, blank: bool) -> Column:
    """All ways to blank (or drop) one more character behind the last one changed."""

    def change(v):
        x = v["x"]

        def at(i):
            head, tail = F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1)
            if blank:
                return F.struct(F.concat(head, F.lit(_BLANK), tail).alias("x"), (i + 1).alias("start"))
            return F.struct(F.concat(head, tail).alias("x"), i.alias("start"))

        return F.transform(_span(v["start"], F.length(x)), at)

    return F.flatten(F.transform(level, change))


def _keys(term: Column, k: int, is_query: bool) -> Column:
    """``array<struct<h, e>>``: hashed keys of a term and the number of edits each stands for."""
    by_edits = {e: [] for e in range(k + 1)}
    dropped = F.array(F.struct(term.alias("x"), F.lit(1).alias("start")))
    for drops in range(k + 1):
        level = F.transform(dropped, lambda v: F.struct(v["x"].alias("x"), F.lit(1).alias("start")))
        for blanks in range(k + 1 - drops):
            for other in range(k + 1 - blanks - drops):
                e = blanks + drops + other
                sides = (drops, other) if is_query else (other, drops)
                by_edits[e].append(_hashes(level, e, *sides))
            level = _edited(level, blank=True)
        dropped = _edited(dropped, blank=False)

    def rows(e):
        hashes = F.array_distinct(F.concat(*by_edits[e]))
        return F.transform(hashes, lambda h: F.struct(h.alias("h"), F.lit(e).alias("e")))

    return F.concat(*[rows(e) for e in by_edits])


def _hashes(level, e, query_drops, term_drops):
    return F.transform(
        level, lambda v: F.xxhash64(F.lit(e), F.lit(query_drops), F.lit(term_drops), v["x"])
    )


def _cut(length: Column, k: int, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i when a term is cut evenly into k + 1; the last ones are
    one longer."""
    base, longer = F.floor(length / (k + 1)).cast("int"), length % (k + 1)
    extra = F.greatest(F.lit(0), F.lit(i) - (k + 1 - longer))
    return (base * i + extra).cast("int"), base + F.when(F.lit(i) >= k + 1 - longer, 1).otherwise(0)


def _named(text: Column, length: Column, i: int, size: Column):
    return lambda p: F.xxhash64(length, F.lit(i), F.substr(text, p + 1, size))


def _segment_keys(term: Column, k: int) -> Column:
    """Hashed keys of a term of more than k characters."""
    length = F.length(term)
    cuts = [_cut(length, k, i) for i in range(k + 1)]
    return F.array(*[_named(term, length, i, size)(start) for i, (start, size) in enumerate(cuts)])


def _segment_probes(query: Column, k: int) -> Column:
    """Keys that a term within k edits of the query can have.

    Segment i is looked for up to i places from where it starts, counted from the left, and up to
    k - i places counted from the right: were it shifted further, more edits than segments would lie
    on that side, and a segment on the other side would be whole too.
    """
    size, found = F.length(query), []
    for more in range(-k, k + 1):  # characters that the query has more than the term
        length = size - more
        for i in range(k + 1):
            start, wide = _cut(length, k, i)
            first = F.greatest(F.lit(0), start - i, start + more - (k - i))
            last = F.least(size - wide, start + i, start + more + (k - i))
            places = F.when(length > k, _span(first, last)).otherwise(F.array().cast("array<int>"))
            found.append(F.transform(places, _named(query, length, i, wide)))
    return F.array_distinct(F.concat(*found))


def _short_pairs(q: DataFrame, t: DataFrame, k: int, spread: int = 16) -> DataFrame:
    """Candidates for terms of at most k characters. All queries of that size match; a longer one
    keeps a character of the term."""
    letters = lambda c: F.array_distinct(F.transform(F.split(F.col(c), ""), lambda x: F.xxhash64(x)))
    any_of = F.transform(F.sequence(F.lit(0), F.lit(spread - 1)), lambda i: i.cast("long"))
    q = q.filter(F.length("query") <= 2 * k).select("query", F.explode(F.when(
        F.length("query") <= k, F.array(F.pmod(F.xxhash64("query"), F.lit(spread)))).otherwise(letters("query"))).alias("h"))
    t = t.filter(F.length("term") <= k).select("term", F.explode(F.concat(any_of, letters("term"))).alias("h"))
    return q.join(t.hint("merge"), "h").select("query", "term")


def match_terms(queries: DataFrame, catalog: DataFrame, k: int = 1, shared: int = 1000) -> DataFrame:
    """Distinct (query, term) pairs within k edits. For k over 1, a segment that more than ``shared``
    terms have is not used as a key: no query meets more candidates by one key."""
    q = queries.select("query").filter(F.col("query").isNotNull()).distinct()
    t = catalog.select("term").filter(F.col("term").isNotNull()).distinct()
    if k == 0:
        return q.join(t, F.col("query") == F.col("term"))
    if k == 1:
        return _match_spelled(q, t, 1)
    q, t = materialize(q, "queries"), materialize(t, "terms")
    index = t.filter(F.length("term") > k).select("term", F.explode(_segment_keys(F.col("term"), k)).alias("h"))
    probes = q.select("query", F.explode(_segment_probes(F.col("query"), k)).alias("h"))
    common = materialize(index.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > shared).select("h"), "common")
    some = not common.isEmpty()
    rare = index.join(common, "h", "left_anti") if some else index
    # exploded rows: their size is not known, so they are never broadcast
    candidates = probes.join(rare.hint("merge"), "h").select("query", "term").unionByName(_short_pairs(q, t, k))
    pairs = candidates.filter(F.levenshtein("query", "term", k) >= 0)
    if some:
        hard_q = probes.join(common, "h", "left_semi").select("query").distinct()
        hard_t = index.join(common, "h", "left_semi").select("term").distinct()
        pairs = pairs.unionByName(_match_spelled(hard_q, hard_t, k))
    return pairs.distinct()


def _match_spelled(q: DataFrame, t: DataFrame, k: int) -> DataFrame:
    """Pairs within k edits, by keys that spell out the edits; for k over 1 a pair may come twice."""
    q = q.select("query", F.inline(_keys(F.col("query"), k, is_query=True)))
    t = t.select("term", F.inline(_keys(F.col("term"), k, is_query=False)).alias("h", "_e"))
    # only at the true distance: fewer repeats, and a check against equal hashes
    return q.join(t.drop("_e").hint("merge"), "h").filter(
        F.levenshtein("query", "term", k) == F.col("e")).select("query", "term")


def match_edit1(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """(query, pos, term) for each distinct query and catalog row within one edit, case
    sensitive; a query without a match has one row with nulls."""
    pairs = match_terms(queries, catalog, 1).join(catalog.select("term", "pos"), "term")
    return queries.select("query").distinct().join(pairs, "query", "left").select(
        "query", "pos", "term"
    )


def match_edit(queries: DataFrame, catalog: DataFrame, k: int = 1) -> DataFrame:
    """Like ``match_edit1`` for k edits, with queries in lower case (the catalog is expected to
    be lower case already)."""
    lowered = queries.select(F.lower("query").alias("query")).distinct()
    pairs = match_terms(lowered, catalog, k).join(catalog.select("term", "pos"), "term")
    return lowered.join(pairs, "query", "left").select("query", "pos", "term")


def suggest(queries: DataFrame | list[str], catalog: DataFrame, n: int = 5,
            term: str = "term", pos: str = "pos") -> DataFrame:
    """First n catalog entries (by ``pos``) that contain the query, both in lower case. Null
    queries and entries match nothing.

    Queries meet the substrings of the catalog that have the length of some query; only those that
    are asked for are ranked, and n rows per substring survive the map side. The lengths come from the
    query table, one row per length.
    """
    lowered = F.lower(F.col(term))
    if isinstance(queries, list):
        typed = [(q,) for q in queries]
        queries = local_table(catalog.sparkSession, typed, "query string")
    asked = queries.select("query", F.lower("query").alias("_part")).filter(F.col("query").isNotNull()).distinct()
    lengths = asked.agg(F.sort_array(F.collect_set(F.length("_part")))).scalar()

    def cuts(size):
        starts = F.when(
            F.length(lowered) >= size, F.sequence(F.lit(1), F.length(lowered) - size + 1)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substr(lowered, i, size))

    pieces = F.array_distinct(F.flatten(F.transform("_lengths", cuts)))
    known = catalog.filter(F.col(term).isNotNull()).select(term, pos, lengths.alias("_lengths"))
    parts = known.select(F.explode(pieces).alias("_part"), term, pos)
    wanted = parts.join(asked.select("_part").distinct(), "_part", "left_semi")
    firsts = top_n_per_key(wanted, ["_part"], [pos], n)
    return asked.join(firsts, "_part").select("query", term, pos)
