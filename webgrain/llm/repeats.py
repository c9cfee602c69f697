"""Shared by the two substring operators: which windows of a corpus also start earlier.

No window is looked up for its own sake. Every window of ``window`` units holds an anchor, a short
sequence picked by its content alone, so equal windows have equal anchors at the same place inside.
Anchors are few (about one in eight words or forty bytes), and only repeated ones are followed up,
at growing lengths. The windows of one anchor in one document form a zone (they overlap), and what is
compared in the end are zones: equal zones but the first are removed whole, and only where one
anchor stands in different zones are their single windows compared.

Each comparison is one aggregation by a fingerprint, which combines before the exchange: a passage
in a third of all documents loads no single task. It returns to the documents what is unique (or
first) as lists of places, so that no row is joined back by its fingerprint. A list is never longer
than its text. The texts are exchanged once, by document, and shared by all passes over them.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W

NULL_ID = (1 << 63) - 1


def identified(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(_r, _d, _h, _t): the order of documents is by id (null last), then by the hash of the text.
    Rows equal in both are one document, named _r."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    return docs.select(F.xxhash64(d, t).alias("_r"), d.alias("_d"), F.xxhash64(t).alias("_h"), t.alias("_t"))


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _signed(x):
    return pa.array(x.view(np.int64))


class Texts:
    """The documents of a batch as one array of units, with their anchors."""

    def __init__(self, batch, finder):
        self.batch, self.window, self.gram = batch, finder.window, finder.gram
        raw, offsets = W.text_bytes(_column(batch, "_t"))
        if finder.of_words:
            self.units, _, _, self.offsets = W.word_units(raw, offsets)
        else:
            self.units, self.offsets = W.mixed(raw.astype(np.uint64) + np.uint64(1)), offsets
        self.prints = W.fingerprints(self.units, self.gram)
        if len(self.units):
            self.at, self.lo, self.hi = W.anchors(
                self.prints, W.room(self.offsets, len(self.units)), self.window, self.gram)
        else:
            self.at = self.lo = self.hi = np.zeros(0, np.int64)

    def keep(self, chosen):
        self.at, self.lo, self.hi = self.at[chosen], self.lo[chosen], self.hi[chosen]

    def listed(self, name, scale=1):
        """The places of a list column, in the array of units; with ``scale`` 2 twice that plus a bit."""
        lists = _column(self.batch, name)
        counts = np.asarray(lists.value_lengths().fill_null(0))
        values = np.asarray(lists.flatten()).astype(np.int64)
        return values + scale * np.repeat(self.offsets[:-1], counts)

    def rows(self, places):
        return np.searchsorted(self.offsets, places, side="right") - 1

    def own(self, name, rows):
        return _column(self.batch, name).take(pa.array(rows))

    def local(self, places, rows):
        return pa.array((places - self.offsets[rows]).astype(np.int32))

    def zones(self):
        """Fingerprints of the text under the windows of each anchor and of the anchor's place in it."""
        z, spans = np.zeros(len(self.at), np.uint64), self.hi - self.lo + self.window
        for size in np.unique(spans):
            same = np.flatnonzero(spans == size)
            z[same] = _prints_at(self.units, self.lo[same], int(size)) + np.uint64(size)
        return W.mixed(z ^ W.mixed((self.at - self.lo).astype(np.uint64)))


class Finder:
    """``window``: units that must repeat. ``lengths``: of the sequences compared, the anchors' first.
    ``of_words``: units are words, else bytes."""

    def __init__(self, window: int, lengths: list[int], of_words: bool):
        self.window, self.gram, self.longer, self.of_words = window, lengths[0], lengths[1:], of_words

    def _run(self, docs, step, schema):
        finder = self

        def pass_(batches):
            for batch in W.slices(batches, "_t"):
                yield from step(finder, Texts(batch, finder))

        return docs.mapInArrow(pass_, schema)

    def _held(self, texts, upto):
        """Drop the anchors that are unique at the lengths compared so far."""
        if upto:
            texts.keep(~np.isin(texts.at, texts.listed("_x0")))
        for k, size in enumerate(self.longer[:max(0, upto - 1)], 1):
            right, left = self._sides(texts, size)
            unique = texts.listed(f"_x{k}", 2)
            texts.keep((right & ~np.isin(2 * texts.at, unique)) | (left & ~np.isin(2 * texts.at + 1, unique)))

    def _sides(self, texts, size):
        """Which anchors have windows with room for ``size`` units from the anchor on, and which have
        windows that hold as many up to its end. A window is in one of the two groups."""
        spare = self.window - size
        return texts.at - texts.hi <= spare, texts.at - texts.lo > spare

    def unique_anchors(self, docs: DataFrame) -> DataFrame:
        def step(finder, x):
            rows = x.rows(x.at)
            yield pa.record_batch([_signed(W.mixed(x.prints[x.at])), x.own("_r", rows), x.local(x.at, rows)],
                                  names=["k", "r", "a"])

        return _unique(self._run(docs, step, "k long, r long, a int"), "_x0")

    def unique_longer(self, docs: DataFrame, k: int) -> DataFrame:
        size = self.longer[k - 1]

        def step(finder, x):
            finder._held(x, k)
            right, left = finder._sides(x, size)
            longer = W.fingerprints(x.units, size)
            right, left = x.at[right], x.at[left]
            keys = np.concatenate([W.mixed(longer[right]), W.mixed(longer[left + finder.gram - size] ^ W._C)])
            places = np.concatenate([right, left])
            rows = x.rows(places)
            side = np.concatenate([np.zeros(len(right), np.int64), np.ones(len(left), np.int64)])
            yield pa.record_batch(
                [_signed(keys), x.own("_r", rows),
                 pa.array((2 * (places - x.offsets[rows]) + side).astype(np.int64))], names=["k", "r", "a"])

        return _unique(self._run(docs, step, "k long, r long, a long"), f"_x{k}")

    def zones(self, docs: DataFrame) -> DataFrame:
        def step(finder, x):
            finder._held(x, 1 + len(finder.longer))
            rows = x.rows(x.at)
            yield pa.record_batch(
                [_signed(x.zones()), _signed(W.mixed(x.prints[x.at])), x.own("_d", rows), x.own("_h", rows),
                 x.own("_r", rows), x.local(x.lo, rows)], names=["z", "k", "d", "h", "r", "lo"])

        return self._run(docs, step, "z long, k long, d long, h long, r long, lo int")

    def _odd(self, texts):
        """Split the held anchors: those of zones that stand earlier, and those of first zones whose
        anchor has other zones too."""
        self._held(texts, 1 + len(self.longer))
        first = np.isin(texts.lo, texts.listed("_first"))
        odd = first & ~np.isin(texts.lo, texts.listed("_alone"))
        return ~first, odd

    def _windows(self, lo, hi):
        n = hi - lo + 1
        return np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def first_windows(self, docs: DataFrame) -> DataFrame:
        def step(finder, x):
            _, odd = finder._odd(x)
            p = finder._windows(x.lo[odd], x.hi[odd])
            rows = x.rows(p)
            second = W.mixed(W.fingerprints(x.units, finder.window, W._C)[p])
            yield pa.record_batch(
                [_signed(W.mixed(W.fingerprints(x.units, finder.window)[p])), _signed(second),
                 x.own("_d", rows), x.own("_h", rows), x.own("_r", rows), x.local(p, rows)],
                names=["w1", "w2", "d", "h", "r", "p"])

        single = self._run(docs, step, "w1 long, w2 long, d long, h long, r long, p int")
        return single.groupBy("w1", "w2").agg(F.min(F.struct("d", "h", "p", "r")).alias("f")).groupBy(
            F.col("f.r").alias("r")).agg(F.collect_list("f.p").alias("_single"))

    def removed(self, texts: "Texts"):
        """First units and ends of what goes, in the array of units."""
        whole, odd = self._odd(texts)
        p = self._windows(texts.lo[odd], texts.hi[odd])
        p = p[~np.isin(p, texts.listed("_single"))]
        return np.concatenate([texts.lo[whole], p]), np.concatenate([texts.hi[whole], p]) + self.window

    def compared(self, docs: DataFrame) -> DataFrame:
        """``docs`` (see ``identified``) with the lists that ``removed`` reads."""
        docs = _with(docs, self.unique_anchors(docs))
        for k in range(1, len(self.longer) + 1):
            docs = _with(docs, self.unique_longer(docs, k))
        heads = self.zones(docs).groupBy("z", "k").agg(F.min(F.struct("d", "h", "lo", "r")).alias("f"))
        first = heads.groupBy(F.col("f.r").alias("r")).agg(F.collect_list("f.lo").alias("_first"))
        alone = heads.groupBy("k").agg(
            F.count("*").alias("n"), F.min("f.r").alias("r"), F.min("f.lo").alias("lo")).filter("n = 1").groupBy(
            "r").agg(F.collect_list("lo").alias("_alone"))
        docs = _with(_with(docs, first), alone)
        return _with(docs, self.first_windows(docs))


def _unique(keys: DataFrame, name: str) -> DataFrame:
    """(r, name): per document the places of the keys that occur once."""
    once = keys.groupBy("k").agg(F.count("*").alias("n"), F.min("r").alias("r"), F.min("a").alias("a")).filter("n = 1")
    return once.groupBy("r").agg(F.collect_list("a").alias(name))


def _with(docs: DataFrame, lists: DataFrame) -> DataFrame:
    return docs.join(lists, F.col("_r") == F.col("r"), "left").drop("r")


def _prints_at(units, starts, size):
    """Fingerprints of ``size`` units at some places only."""
    if len(starts) * 8 > len(units):
        return W.fingerprints(units, size)[starts]
    out, power = np.zeros(len(starts), np.uint64), 1
    for j in range(size):
        out += units[starts + j] * np.uint64(power)
        power = power * int(W._B) & ((1 << 64) - 1)
    return out


def removal_mask(lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    edges = np.zeros(size + 1, np.int32)
    np.add.at(edges, lo, 1)
    np.add.at(edges, hi, -1)
    return np.cumsum(edges[:-1]) > 0
