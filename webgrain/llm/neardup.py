"""Near-duplicate documents by a chosen-path similarity join.

Documents are sets of word shingles. In every tree of the join a node holds documents that agree on
a path of minwise tokens: at each node a few coordinates of the signature are selected by the node
itself, and a document moves on to the child of its own token at each of them. Nodes with few
documents are compared exhaustively; documents of larger ones are joined exactly, by what they
differ in from the consensus of the node. Independent trees are repeated until a pair at the threshold
is missed with the wanted probability only. What the trees propose is confirmed on the full sets.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W
from webgrain.llm.common import stored
from webgrain.llm.components import components

COORDINATES = 128  # of a signature, 16 bits each
BRANCHES = 2  # coordinates selected at a node
MAX_DEPTH = 6
ALIKE = 0.5  # agreement with a pivot from which a document of a large node is joined exactly
LEVELS = 12  # of groups of common differences; larger ones left then are compared in blocks

_A = W.mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_X = W.mixed(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def shingle_sets(column: pa.Array, words: int):
    """Distinct shingles of all texts: sorted fingerprints and the offsets of the documents. A-Z are
    lower-cased; a text with fewer words is one shingle, one without words none."""
    raw, offsets = W.text_bytes(column)
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw).astype(np.uint8)
    units, _, _, counts = W.word_units(raw, offsets)
    n = np.diff(counts)
    found, rows = [], []
    if len(units):
        whole = np.flatnonzero(W.room(counts, len(units)) >= words)
        found.append(W.mixed(W.fingerprints(units, words)[whole]))
        rows.append(np.searchsorted(counts, whole, side="right") - 1)
        for k in range(1, words):
            short = np.flatnonzero(n == k)
            if len(short):
                found.append(W.mixed(W.fingerprints(units, k)[counts[short]] + np.uint64(k)))
                rows.append(short)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    prints, rows = np.concatenate(found), np.concatenate(rows)
    order = np.lexsort((prints, rows))
    prints, rows = prints[order], rows[order]
    first = np.ones(len(prints), bool)
    first[1:] = (prints[1:] != prints[:-1]) | (rows[1:] != rows[:-1])
    prints, rows = prints[first], rows[first]
    return prints, np.searchsorted(rows, np.arange(len(n) + 1))


def signatures(prints: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minwise tokens per non-empty document (rows) and coordinate (columns)."""
    some = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(some), COORDINATES), np.uint16)
    for i in range(COORDINATES):
        least = np.minimum.reduceat((prints ^ _X[i]) * _A[i], some) if len(some) else prints
        out[:, i] = (W.mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def sketch(docs: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sig): size, two sums that name the set, and its signature."""

    def step(batches):
        for batch in W.slices(batches, "t"):
            prints, offsets = shingle_sets(batch.column(1), words)
            n = np.diff(offsets)
            some = np.flatnonzero(n > 0)
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            sig = [None] * len(n)
            if len(some):
                s1[some] = np.add.reduceat(W.mixed(prints ^ W._B), offsets[some])
                s2[some] = np.add.reduceat(W.mixed(prints ^ W._C), offsets[some])
                for r, s in zip(some.tolist(), signatures(prints, offsets)):
                    sig[r] = s.tobytes()
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "s1", "s2", "sig"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        step, "doc_id long, n_shingles long, s1 long, s2 long, sig binary")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), COORDINATES)


def _children(nodes: np.ndarray, sig: np.ndarray, branch: int) -> np.ndarray:
    """The node selects a coordinate, the document's token there the child."""
    at = W.mixed(nodes ^ np.uint64(0x51ED270B)) % np.uint64(COORDINATES)
    at = (at + np.uint64(branch * 61)) % np.uint64(COORDINATES)
    token = sig[np.arange(len(sig)), at.astype(np.int64)].astype(np.uint64)
    return W.mixed(W.mixed(nodes + np.uint64(branch + 1)) ^ (token << np.uint64(8)) ^ at)


def _grow(rows: DataFrame, levels: int) -> DataFrame:
    """(node, v) of the children ``levels`` down, from rows of (node, v, sig)."""

    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column(2))
            nodes = [np.asarray(batch.column(0)).view(np.uint64)]
            for _ in range(levels):
                nodes = [_children(n, sig, k) for n in nodes for k in range(BRANCHES)]
            yield pa.record_batch(
                [pa.array(np.concatenate(nodes).view(np.int64)),
                 pa.concat_arrays([batch.column(1)] * len(nodes))], names=["node", "v"])

    return rows.select("node", "v", "sig").mapInArrow(step, "node long, v long")


def _compare_small(small: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs of the documents of a small node whose signatures agree well enough (a, b, est)."""
    groups = small.join(sketches.select("v", "sig"), "v").groupBy("node").agg(
        F.collect_list(F.struct("v", "sig")).alias("g")).select("g.v", "g.sig")

    def step(batches):
        for batch in batches:
            a, b, est = [], [], []
            for ids, sigs in zip(batch.column(0), batch.column(1)):
                v, m = np.asarray(ids.values), _matrix(sigs.values)
                i, j = np.triu_indices(len(v), 1)
                agree = (m[i] == m[j]).mean(axis=1)
                good = agree >= least
                a.append(np.minimum(v[i], v[j])[good])
                b.append(np.maximum(v[i], v[j])[good])
                est.append(agree[good])
            if a:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (a, b, est)], names=["a", "b", "est"])

    return groups.mapInArrow(step, "a long, b long, est double")


def _against_pivots(large: DataFrame, sketches: DataFrame, sample: int) -> DataFrame:
    """(node, v, p, est): every document of a large node with the node's pivot.

    The pivot is the one of a few of the node's documents (one per value of a hash) that agrees best
    with the tokens most common among them. Nodes of much the same documents have the same pivot,
    and a pair of document and pivot is compared once, whatever the number of its nodes.
    """
    few = (
        large.groupBy("node", F.pmod(F.xxhash64("v"), F.lit(sample)).alias("_c"))
        .agg(F.min_by("v", F.xxhash64("v", F.lit(1))).alias("v"))
        .join(sketches.select("v", "sig"), "v")
        .groupBy("node").agg(F.collect_list(F.struct("v", "sig")).alias("s")).select("node", "s.v", "s.sig"))

    def best(batches):
        for batch in batches:
            out = []
            for ids, sigs in zip(batch.column(1), batch.column(2)):
                v, m = np.asarray(ids.values), _matrix(sigs.values)
                order = np.argsort(v)
                v, m = v[order], m[order]
                agree = sum((m == row).astype(np.int64) for row in m)  # how common each token is
                common = agree.max(axis=0)
                out.append(int(v[(agree == common).sum(axis=1).argmax()]))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.int64())], names=["node", "p"])

    pivots = few.mapInArrow(best, "node long, p long")
    rows = stored(large.join(pivots, "node").select("node", "v", "p"), "pivots")
    pairs = (
        rows.select("v", "p").distinct().join(sketches.select("v", "sig"), "v")
        .join(sketches.select(F.col("v").alias("p"), F.col("sig").alias("psig")), "p").select("v", "p", "sig", "psig"))

    def estimate(batches):
        for batch in batches:
            if batch.num_rows:
                est = (_matrix(batch.column(2)) == _matrix(batch.column(3))).mean(axis=1)
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(est)], names=["v", "p", "est"])

    return rows.join(pairs.mapInArrow(estimate, "v long, p long, est double"), ["v", "p"])


def _member_sets(members: DataFrame, docs: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """(v, n, set): the sorted shingles of the documents named by ``members`` (v)."""
    texts = docs.select(F.col(doc_id).cast("long").alias("v"), F.col(text).cast("string").alias("t"))

    def step(batches):
        for batch in W.slices(batches, "t"):
            prints, offsets = shingle_sets(batch.column(1), words)
            sets = [prints[i:j].tobytes() for i, j in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(sets, pa.binary())],
                                  names=["v", "n", "set"])

    return texts.join(members.select("v").distinct(), "v", "left_semi").mapInArrow(
        step, "v long, n long, set binary").filter("n > 0").distinct()


def _differences(large: DataFrame, sets: DataFrame, sample: int) -> DataFrame:
    """(g, v, n, d): the shingles in which a document of a group differs from the group's consensus,
    those rare in the group first. The consensus has the shingles of most of a few documents."""
    few = (
        large.groupBy("g", F.pmod(F.xxhash64("v"), F.lit(sample)).alias("_c"))
        .agg(F.min_by("v", F.xxhash64("v", F.lit(1))).alias("v"))
        .join(sets, "v").groupBy("g").agg(F.collect_list("set").alias("s")))

    def agreed(batches):
        for batch in batches:
            known, counts, of = [], [], []
            for some in batch.column(1):
                one = [np.frombuffer(x, np.uint64) for x in some.as_py()]
                token, count = np.unique(np.concatenate(one), return_counts=True)
                often = (count > 1) | (2 * count > len(one))
                known.append(token[often].tobytes())
                counts.append(count[often].astype(np.uint16).tobytes())
                of.append(len(one))
            yield pa.record_batch([batch.column(0), pa.array(known, pa.binary()), pa.array(counts, pa.binary()),
                                   pa.array(of, pa.int64())], names=["g", "known", "counts", "k"])

    consensus = stored(few.mapInArrow(agreed, "g long, known binary, counts binary, k long"), "consensus")
    rows = large.join(sets, "v").join(consensus, "g").select("g", "v", "n", "set", "known", "counts", "k")

    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for mine, known, counts, k in zip(*(batch.column(c) for c in range(3, 7))):
                token, count = np.frombuffer(known.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.uint16)
                count, k = count.astype(np.int64), k.as_py()
                most = 2 * count > k
                d = np.setxor1d(np.frombuffer(mine.as_buffer(), np.uint64), token[most], assume_unique=True)
                often = np.zeros(len(d), np.int64)  # how many of the few differ there too
                if len(token):
                    at = np.minimum(np.searchsorted(token, d), len(token) - 1)
                    often = np.where(token[at] == d, np.where(most[at], k - count[at], count[at]), 0)
                out.append(d[np.lexsort((d, often))].view(np.int64))
            sizes = np.cumsum([0] + [len(x) for x in out])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(out), pa.int64()))],
                names=["g", "v", "n", "d"])

    return rows.mapInArrow(step, "g long, v long, n long, d array<long>")


def _all_blocks(large: DataFrame, small: int) -> DataFrame:
    """(node, v): every two documents of a large group meet in a block of about ``small``."""
    sizes = large.groupBy(F.col("g").alias("g1")).agg(F.ceil(2 * F.count("*") / small).cast("int").alias("m"))
    mine = F.pmod(F.xxhash64("v", "g"), F.col("m")).cast("int")
    return large.join(sizes, F.col("g") == F.col("g1")).select("g", "v", mine.alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("m") - 1)).alias("j")).select(
            F.xxhash64("g", F.least("i", "j"), F.greatest("i", "j")).alias("node"), "v").distinct()


def _join_groups(groups: DataFrame, sketches: DataFrame, docs: DataFrame, least: float, percent: int, small: int,
                 words: int, text: str, doc_id: str) -> list:
    """Pairs (a, b, est) that link all linked documents of each large group (g, v).

    Documents are compared by their differences d to the group's consensus: the pair is linked if
    (100 - percent) * (n + n') >= (100 + percent) * (|d| + |d'| - 2 * common). With the slack
    (100 - percent) * n - (100 + percent) * |d| of each, two whose slacks add up to 0 at least are linked
    whatever they have in common. All that are so linked with the one of most slack are one
    component and not compared among each other. Every other linked pair has common differences,
    one of them among the first few of both (prefix filter): these form the groups of the next level.
    """
    sets = stored(_member_sets(groups, docs, words, text, doc_id), "sets")
    found, large = [], groups
    for _ in range(LEVELS):
        diffs = stored(_differences(large, sets, small), "differences").withColumn("slack", F.lit(100 - percent) * F.col("n")
            - F.lit(100 + percent) * F.size("d"))
        hubs = stored(diffs.groupBy(F.col("g").alias("g1")).agg(F.max(F.struct("slack", "v")).alias("hub"),
                                                               F.min("slack").alias("low")), "hubs")
        rows = diffs.join(hubs, F.col("g") == F.col("g1"))
        top = F.col("hub.slack")
        star = F.col("slack") + top >= 0
        found.append(rows.filter(star & (F.col("v") != F.col("hub.v"))).select(
            F.least("v", "hub.v").alias("a"), F.greatest("v", "hub.v").alias("b"), F.lit(1.0).alias("est")))
        # least number of common differences of a linked pair that the star does not link
        common = F.greatest(
            F.when(star, F.floor((top - F.col("slack")) / (2 * (100 + percent))) + 1)
            .otherwise(F.ceil(-(top + F.col("slack")) / (2 * (100 + percent)))),
            F.size("d") - F.floor((100 - percent) * F.col("n") / percent))
        length = (F.size("d") - common + 1).cast("int")
        parts = rows.filter(F.col("low") + top < 0).select("g", "v", star.alias("star"), length.alias("l"), "d").filter(
            "l > 0").select("v", "star", "g", F.explode(F.slice("d", F.lit(1), F.col("l"))).alias("x")).select(
                "v", "star", F.xxhash64("g", "x").alias("g"))
        sizes = parts.groupBy(F.col("g").alias("g2")).agg(F.count("*").alias("n"), F.min("star").alias("all")).filter(
            "n > 1 and not all")
        sized = stored(parts.join(sizes, F.col("g") == F.col("g2")).select("g", "v", "n").distinct(), "groups")
        found.append(_compare_small(sized.filter(f"n <= {small}").select(F.col("g").alias("node"), "v"), sketches, least))
        large = sized.filter(f"n > {small}").select("g", "v")
        if not large.limit(1).count():
            return found
    return [*found, _compare_small(_all_blocks(large, small), sketches, least)]


def candidates(sketches: DataFrame, docs: DataFrame, least: float, percent: int, trees: int, small: int, words: int,
               text: str, doc_id: str) -> DataFrame:
    """(a, b, est): pairs proposed by the trees; sketches has one row (v, sig) per distinct set.

    The documents of a large node that look like its pivot, and all of one at the last depth, are
    joined exactly; those that do not move on to the children. Two signatures that agree on ``least``
    differ by 1 - ``least`` at most in their agreement with the pivot, so between ALIKE and
    that much below it a document does both, and no pair is parted.
    """
    seeds = F.explode(F.array(*[F.lit(int(x)) for x in W.mixed(
        np.arange(7001, 7001 + trees, dtype=np.uint64)).view(np.int64)])).alias("node")
    live = _grow(sketches.select(seeds, "v", "sig"), 2)
    found, groups = [], []
    for depth in range(2, MAX_DEPTH + 1):
        live = stored(live, "nodes")
        sizes = live.groupBy(F.col("node").alias("n1")).agg(F.count("*").alias("n")).filter("n > 1")
        sized = stored(live.join(sizes, F.col("node") == F.col("n1")).select("node", "v", "n"), "nodes")
        found.append(_compare_small(sized.filter(f"n <= {small}").select("node", "v"), sketches, least))
        large = sized.filter(f"n > {small}").select("node", "v")
        if not large.limit(1).count():
            break
        starred = stored(_against_pivots(large, sketches, small), "starred")
        alike = starred if depth == MAX_DEPTH else starred.filter(f"est >= {ALIKE - (1 - least)}")
        groups.append(alike.select(F.col("p").alias("g"), "v"))
        live = _grow(starred.filter(f"est < {ALIKE}").select("node", "v").distinct().join(
            sketches.select("v", "sig"), "v"), 1)
    if groups:
        whole = groups[0]
        for more in groups[1:]:
            whole = whole.unionByName(more)
        whole = stored(whole.distinct(), "groups")
        found += _join_groups(whole, sketches, docs, least, percent, small, words, text, doc_id)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return stored(pairs.groupBy("a", "b").agg(F.max("est").alias("est")), "candidates")


def confirm(pairs: DataFrame, docs: DataFrame, words: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """Those pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    texts = docs.select(F.col(doc_id).cast("long").alias("v"), F.col(text).cast("string").alias("t"))
    one = pairs.select("a", "b").join(texts, F.col("a") == F.col("v")).select("a", "b", F.col("t").alias("ta"))
    two = one.join(texts, F.col("b") == F.col("v")).select("a", "b", "ta", F.col("t").alias("tb"))

    def step(batches):
        for batch in W.slices(batches, "ta", "tb"):
            (x, xo), (y, yo) = shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words)
            good = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                s, t = x[xo[r]:xo[r + 1]], y[yo[r]:yo[r + 1]]
                both = len(np.intersect1d(s, t, assume_unique=True))
                good[r] = 100 * both >= percent * (len(s) + len(t) - both) and len(s) > 0
            kept = pa.array(good)
            yield pa.record_batch([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return two.mapInArrow(step, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
                    miss: float = 1e-4, small: int = 48) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents are linked if their sets of ``words``-word shingles (A-Z lower-cased) have a Jaccard
    similarity of ``percent`` at least. ``component_id`` is the least doc_id reachable over links,
    ``kept`` marks that document. ``miss`` bounds the chance that a pair at the threshold meets in no
    node of any tree, ``small`` the documents of a node that is compared exhaustively.

    Null and empty texts have no shingles and no links. A null id has no component (null) and is
    kept; rows with one id are one vertex. Equal sets, however many, are one vertex of the join.
    Texts are used whole; an empty table gives an empty result; other columns are not read.
    """
    level = percent / 100
    fail = 0.0  # that a pair at the threshold shares no node at the last depth of a tree
    for _ in range(MAX_DEPTH):
        fail = (1 - level + level * fail) ** BRANCHES
    trees = max(1, math.ceil(math.log(miss) / math.log(fail)))
    spread = math.sqrt(level * (1 - level) / COORDINATES)
    sketches = stored(sketch(docs, words, text, doc_id), "sketches")
    classes = stored(
        sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("v"), F.first("sig").alias("sig")), "classes")
    found = candidates(classes.select("v", "sig"), docs, level - 4 * spread, percent, trees, small, words, text, doc_id)
    # first the best partner of every document, then what still stands between components
    ends = found.select(F.col("a").alias("x"), "a", "b", "est").union(found.select("b", "a", "b", "est"))
    best = ends.groupBy("x").agg(F.max_by(F.struct("a", "b"), F.struct("est", -F.col("a"), -F.col("b"))).alias("p"))
    first = stored(best.select("p.a", "p.b").distinct(), "pairs")
    links = stored(confirm(first, docs, words, percent, text, doc_id), "confirmed")
    labels = components(links)
    label = lambda x: labels.select(F.col("v").alias(x), F.col("c").alias(f"c{x}"))
    open_pairs = (
        found.join(first, ["a", "b"], "left_anti").join(label("a"), "a", "left").join(label("b"), "b", "left")
        .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    more = stored(confirm(stored(open_pairs, "pairs"), docs, words, percent, text, doc_id), "confirmed")
    labels = components(links.unionByName(more))
    member = classes.join(labels, "v", "left").select("s1", "s2", F.coalesce("c", "v").alias("_c"))
    return sketches.join(member, ["s1", "s2"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("_c", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
