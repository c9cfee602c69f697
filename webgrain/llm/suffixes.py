"""Substring dedup on bytes, with fingerprints in place of prefix doubling.

Prefix doubling was replaced: nothing is ranked, sorted or reranked here. Positions are anchors picked
by content, which every string of the wanted length holds (``repeats``). What is compared grows: 25
bytes at each anchor settle those that are unique, then all windows of an anchor are compared as one
zone. Zones that share an anchor but not their text are cut into parts of ``STEP`` windows. A part has
a core, the bytes that all its windows share: a part with a core of its own is settled, as is one whose
bytes all stand in an earlier part. Single windows are compared only where parts share a core but not
their ends, which is at the two ends of a repeated passage.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W
from webgrain.llm.common import stored
from webgrain.llm.repeats import NULL_ID, Finder, Texts, _signed, removal_mask

STEP = 12  # windows of a part
ROW = "z long, k long, d long, h long, lo int"
SLICE = 1 << 18  # bytes of text worked on at a time: the arrays stay in the processor's caches


def _prints(units, base):
    """A function of (starts, ends) that gives the fingerprints of these ranges, from prefix sums."""
    n = len(units)
    powers, back = np.full(n + 1, base), np.full(n + 1, np.uint64(pow(int(base), -1, 1 << 64)))
    powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(n + 1, np.uint64)
    np.add.accumulate(units * powers[:-1], out=sums[1:])
    return lambda a, b: W.mixed((sums[b] - sums[a]) * back[a])


class ByteFinder(Finder):
    """``window``: bytes that must repeat. ``gram``: bytes of an anchor."""

    def __init__(self, window: int, gram: int):
        super().__init__(window, [gram], of_words=False)
        self.step = min(STEP, window)

    def _run(self, docs, step, schema):
        finder = self

        def pass_(batches):
            for batch in _opened(batches):
                yield from step(finder, Texts(batch, finder))

        return docs.mapInArrow(pass_, schema)

    def _rows(self, x, z, k, lo):
        rows = x.rows(lo)
        return pa.record_batch([_signed(z), _signed(k), x.own("_d", rows), x.own("_h", rows), x.local(lo, rows)],
                               names=["z", "k", "d", "h", "lo"])

    def repeated(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the places of the anchors that are unique."""
        def step(finder, x):
            rows = x.rows(x.at)
            yield pa.record_batch(
                [_signed(W.mixed(x.prints[x.at])), x.own("_d", rows), x.own("_h", rows), x.local(x.at, rows)],
                names=["k", "d", "h", "lo"])

        return _with(docs, _unique(self._run(docs, step, "k long, d long, h long, lo int")), "_x0")

    def zones(self, docs: DataFrame) -> DataFrame:
        """A row for each zone whose anchor is repeated: all its bytes and the anchor's place (z), the
        anchor (k)."""
        def step(finder, x):
            finder._held(x, 1)
            if len(x.at):
                whole = _prints(x.units, W._C)(x.lo, x.hi + finder.window)
                z = W.mixed(whole + W.mixed(((x.at - x.lo) * 2 * finder.window + x.hi - x.lo).astype(np.uint64)))
                yield finder._rows(x, z, W.mixed(x.prints[x.at]), x.lo)

        return self._run(docs, step, ROW)

    def _parts(self, x, odd):
        """(base, first, last): the parts of odd zones. Windows base .. base + step - 1 stand at the
        same places to an anchor in all texts; first and last are those that the zone has."""
        at, lo, hi = x.at[odd], x.lo[odd], x.hi[odd]
        low, high = (lo - at) // self.step, (hi - at) // self.step
        part = self._windows(low, high)
        zone = np.repeat(np.arange(len(at)), high - low + 1)
        base = at[zone] + part * self.step
        return part, base, np.maximum(lo[zone], base), np.minimum(hi[zone], base + self.step - 1)

    def parts(self, docs: DataFrame) -> DataFrame:
        """A row for each part of an odd zone: all its bytes (z), its core (k)."""
        def step(finder, x):
            _, odd = finder._odd(x)
            if odd.any():
                part, base, first, last = finder._parts(x, odd)
                core = _prints(x.units, W._B)(base + finder.step - 1, base + finder.window)
                whole = _prints(x.units, W._C)(first, last + finder.window)
                ends = (first - base) * finder.step + last - first
                k = W.mixed(core + W.mixed(part.astype(np.uint64)))
                yield finder._rows(x, W.mixed(whole + W.mixed(ends.astype(np.uint64))), k, first)

        return self._run(docs, step, ROW)

    def _odd(self, texts):
        self._held(texts, 1)
        first, alone = _told(texts, "_zones", texts.lo)
        return ~first, first & ~alone

    def _open(self, texts):
        """First and last starts of the parts that stand earlier, and all starts that are left open."""
        whole, odd = self._odd(texts)
        _, _, start, last = self._parts(texts, odd)
        first, alone = _told(texts, "_parts", start)
        left = first & ~alone
        gone = np.concatenate([texts.lo[whole], start[~first]]), np.concatenate([texts.hi[whole], last[~first]])
        return gone, self._windows(start[left], last[left])

    def first_windows(self, docs: DataFrame) -> DataFrame:
        def step(finder, x):
            _, p = finder._open(x)
            if len(p):
                one, two = (_prints(x.units, base)(p, p + finder.window) for base in (W._B, W._C))
                yield finder._rows(x, one, two, p)

        return _heads(self._run(docs, step, ROW)).select("f.*")

    def removed(self, texts: Texts):
        (lo, hi), p = self._open(texts)
        p = p[~np.isin(p, texts.listed("_single"))]
        return np.concatenate([lo, p]), np.concatenate([hi, p]) + self.window

    def compared(self, docs: DataFrame) -> DataFrame:
        docs = self.repeated(docs)
        docs = _with(docs, _firsts(self.zones(docs)), "_zones")
        docs = _with(docs, _firsts(self.parts(docs)), "_parts")
        return _with(docs, self.first_windows(docs), "_single")


def _named(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(_d, _h, _t): documents in order. _h is 0 where the id is the row's own (zeros cost next to
    nothing in an exchange), else the hash of the text: rows equal in both are one document. The ids
    in question are stored, so that Spark knows their size when it chooses the join."""
    named = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("_d"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    shared = stored(named.groupBy(F.col("_d").alias("d")).agg(F.count("*").alias("n")).filter("n > 1").select("d"), "ids")
    return named.join(shared, F.col("_d") == F.col("d"), "left").select(
        "_d", F.when(F.col("d").isNull(), F.lit(0)).otherwise(F.xxhash64("_t")).cast("long").alias("_h"), "_t")


def _closed(docs: DataFrame) -> DataFrame:
    """The texts as one zstandard frame each: they are exchanged once and read by every pass."""
    def close(batches):
        pack = zstandard.ZstdCompressor()
        for batch in batches:
            texts = (pack.compress(t.as_buffer()) for t in batch.column(2).cast(pa.large_binary()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["_d", "_h", "_t"])

    return docs.mapInArrow(close, "_d long, _h long, _t binary")


def _opened(batches):
    """The batches cut by the bytes of their texts, which are unpacked a cut at a time."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        at, first, texts, size = batch.schema.get_field_index("_t"), 0, [], 0
        for k, frame in enumerate(batch.column(at)):
            texts.append(unpack.decompress(frame.as_buffer()))
            size += len(texts[-1])
            if size >= SLICE or k + 1 == batch.num_rows:
                yield batch.slice(first, k + 1 - first).set_column(at, "_t", pa.array(texts, pa.large_string()))
                first, texts, size = k + 1, [], 0


def _with(docs: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """``docs`` with the places (d, h, lo) as a list per document. They are dealt by document before
    they are put together: most documents have few in any one task, so lists would only be larger."""
    lists = places.repartition("d", "h").groupBy("d", "h").agg(F.collect_list("lo").alias(name))
    return docs.join(lists, (F.col("_d") == F.col("d")) & (F.col("_h") == F.col("h")), "left").drop("d", "h")


def _heads(rows: DataFrame) -> DataFrame:
    return rows.groupBy("z", "k").agg(F.min(F.struct("d", "h", "lo")).alias("f"))


def _unique(rows: DataFrame) -> DataFrame:
    return rows.groupBy("k").agg(
        F.count("*").alias("n"), F.min("d").alias("d"), F.min("h").alias("h"), F.min("lo").alias("lo")).filter(
        "n = 1").select("d", "h", "lo")


def _firsts(rows: DataFrame) -> DataFrame:
    """Twice the places of the first rows of each (z, k), and one more for those whose k has no other z."""
    heads = _heads(rows).select("k", "f.*")
    return heads.select("d", "h", (2 * F.col("lo").cast("long")).alias("lo")).unionAll(
        _unique(heads).select("d", "h", 2 * F.col("lo").cast("long") + 1))


def _told(texts: Texts, name: str, places):
    """Which of ``places`` are first, and which are the only ones of their kind, by ``_firsts``."""
    codes = texts.listed(name, 2)
    return np.isin(2 * places, codes), np.isin(2 * places + 1, codes)


def dedup_bytes(docs: DataFrame, window: int = 100, start: int = 25, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``: each byte
    of the UTF-8 text covered by a string of ``window`` bytes that also starts earlier (smaller id,
    or earlier in the same document) is removed; strings are judged on the input and never cross
    documents. ``kept`` has the remaining bytes, ``n_spans`` counts the maximal removed runs.

    Null texts count as empty. A null id comes after all others; rows with equal ids are ordered by
    the hash of their text, and rows equal in both are one document: each gets its result. Texts of
    any length are used whole. An empty table gives an empty result. Other columns are not read.
    """
    if not 0 < start <= window:
        raise ValueError("start must be between 1 and window")
    finder = ByteFinder(window, start)

    def kept(batches):
        for batch in _opened(batches):
            texts = Texts(batch, finder)
            gone = removal_mask(*finder.removed(texts), len(texts.units))
            raw, offsets = W.text_bytes(batch.column(batch.schema.get_field_index("_t")))
            out = []
            for d, first, end in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                mine = gone[first:end]
                spans = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(len(mine) > 0 and mine[0])
                rest = raw[first:end][~mine].tobytes()
                out.append((None if d == NULL_ID else d, rest, int(end - first), int(mine.sum()), spans,
                            hashlib.sha256(rest).hexdigest()))
            yield pa.record_batch(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(
                    (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return finder.compared(_closed(_named(docs, text, doc_id))).mapInArrow(
        kept, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
