"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so that a question asked with other parameters
has the template of the original. Windows of template words of documents and benchmark are joined by
their hash; then the slots are compared: along one alignment the same benchmark value must always
stand for the same document value.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W
from webgrain.llm.common import packed, stored, unpacked

# Words for numbers and units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion".split())
UNIT_WORDS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds "
    "ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hrs "
    "hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur "
    "percent degree degrees watt watts volt volts mph kmh".split())
_NUMBER = re.compile(rb"[+-]?(?:[$]|\xe2\x82\xac|\xc2\xa3)?\d[\d.,:/]*(?:%|st|nd|rd|th|[a-z]{1,3})?$")
_EDGES = re.compile(rb"^[^0-9A-Za-z\x80-\xff+$-]+|[^0-9A-Za-z\x80-\xff%]+$")
NUM, UNIT, NAME = (W.mixed(np.arange(901, 904, dtype=np.uint64))[i] for i in range(3))
LITERAL = 2  # form of the windows that are mostly placeholders: compared with their values
CACHE_WORDS = 1_000_000
BLOCK_WINDOWS = 500_000  # benchmark windows that the tasks hold at a time


class Templates:
    """Template words of texts; remembers words within a Python worker."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.index = {}
        # kind of each known word: 0 word, 1 number, 2 unit, 3 nothing left
        self.prints, self.kinds = np.zeros(1024, np.uint64), np.zeros(1024, np.int8)
        self.capital, self.ends = np.zeros(1024, bool), np.zeros(1024, bool)

    def _add(self, word: bytes) -> int:
        plain = word.isalpha()  # ASCII letters only
        core = word if plain else _EDGES.sub(b"", word)
        low = core.lower()
        text = low.decode("utf-8", "replace")
        n = self.index[word] = len(self.index)
        if n == len(self.prints):
            self.prints, self.kinds, self.capital, self.ends = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.prints, self.kinds, self.capital, self.ends))
        self.prints[n] = hash_text(text)
        self.kinds[n] = (
            3 if not core else 1 if not plain and _NUMBER.match(low) or text in NUMBER_WORDS else 2 if text in UNIT_WORDS else 0)
        self.capital[n] = len(core) > 1 and core[:1].isupper() and not core.isupper()
        self.ends[n] = word[-1:] in b".!?:\"'" or word[:1] in b"\"'("
        return n

    def of(self, texts: list[str]):
        """(words, places of template words, their offsets by text, with names, without names, literal,
        placeholder marks of the first two): the template words of all texts, in one long array, with names
        replaced, with names as words, and with nothing replaced."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        known, add = self.index.get, self._add
        words, offsets = [], [0]
        for text in texts:
            words += text.encode("utf-8", "replace").split()
            offsets.append(len(words))
        ids = list(map(known, words))
        if None in ids:
            ids = [k if k is not None else known(w) if w in self.index else add(w) for k, w in zip(ids, words)]
        at = np.array(ids, np.int64)
        kinds, capital, ends = self.kinds[at], self.capital[at], self.ends[at]
        some = np.flatnonzero(kinds != 3)
        first = np.ones(len(at), bool)
        first[1:] = ends[:-1]
        first[[o for o in offsets if o < len(at)]] = True
        cuts = np.searchsorted(some, offsets)
        prints, kinds, capital, first = self.prints[at[some]], kinds[some], capital[some], first[some]
        number = kinds == 1
        unit = np.zeros(len(some), bool)
        unit[1:] = (kinds[1:] == 2) & number[:-1]
        unit[cuts[cuts < len(some)]] = False  # the number stood in the text before
        plain = np.where(number, NUM, np.where(unit, UNIT, prints))
        name = capital & ~first & ~number & ~unit
        named = np.where(name, NAME, plain)
        return words, some, cuts, named, plain, prints, number | unit | name, number | unit


def hash_text(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


_worker: list = []


def _templates() -> Templates:
    if not _worker:
        _worker.append(Templates())
    return _worker[0]


def _template_windows(texts: list[str], lengths: list[int]):
    """(words, places of template words, offsets by text, form, starts, keys, slots, n) of the windows of
    the texts with ``n`` of ``lengths`` template words, in both forms. At least half of a window's words
    are words; other windows are taken literally."""
    found = _templates().of(texts)
    room = W.room(found[2], len(found[1]))
    return [x for n in lengths for x in _of_length(*found, room, n)]


def _of_length(words, some, cuts, named, plain, prints, slots_n, slots_p, room, n):
    out = []
    whole = len(some) - n + 1
    inside = room[:max(whole, 0)] >= n
    if not inside.any():
        return out
    count = [np.cumsum(np.concatenate([[0], x])) for x in (slots_n, slots_p)]
    fixed = [n - (c[n:] - c[:whole]) for c in count]
    for form, units in enumerate((named, plain, prints)):
        slots = (slots_n, slots_p, np.zeros(len(some), bool))[form]
        if form == LITERAL:
            p = np.flatnonzero((2 * fixed[1] < n) & inside)
        elif form:  # the forms differ only where a window has a name
            p = np.flatnonzero((2 * fixed[1] >= n) & (fixed[0] != fixed[1]) & inside)
        else:
            p = np.flatnonzero((2 * fixed[0] >= n) & inside)
        if len(p):
            keys = W.mixed(W.fingerprints(units, n)[p] + np.uint64(n))
            out.append((words, some, cuts, form, p, keys, slots, n))
    return out


def _values(words, some, slots, p, n):
    return [words[some[k]].decode("utf-8", "replace").strip(".,;:!?\"'()").lower() for k in range(p, p + n) if slots[k]]


_ROWS = "key long, form int, pos int, slots array<string>"


def benchmark_windows(benchmark: DataFrame, size: int, shortest: int, text: str, item_id: str) -> DataFrame:
    """(item_id, key, form, pos, slots, n, n_windows, n_free) of every item, n_free without literal windows; an item of less than ``size``
    words is one window of its own length ``n``, one of less than ``shortest`` has none."""

    def step(batches):
        for batch in batches:
            rows = []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                length = min(size, len(_templates().of([t or ""])[1]))
                found = _template_windows([t or ""], [length] if length >= shortest else [])
                total = len({int(p) for f in found for p in f[4]})
                free = len({int(p) for f in found for p in f[4] if f[3] != LITERAL})
                for words, some, _, form, p, keys, slots, n in found:
                    for k, key in zip(p.tolist(), keys.view(np.int64).tolist()):
                        rows.append((item, key, form, k, _values(words, some, slots, k, n), n, total, free))
            columns = list(zip(*rows)) or [[]] * 8
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int32()))],
                names=["item_id", "key", "form", "pos", "slots", "n", "n_windows", "n_free"])

    return benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        step, f"item_id long, {_ROWS}, n int, n_windows int, n_free int")


def _document_windows(docs: DataFrame, keys, lengths: list[int]) -> DataFrame:
    """Windows of documents whose key is one of ``keys`` (a broadcast sorted array)."""

    def step(batches):
        wanted = keys.value
        for batch in W.slices(batches, "t"):
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for words, some, cuts, form, p, found, slots, n in _template_windows(texts, lengths):
                at = np.searchsorted(wanted, found)
                at[at == len(wanted)] = 0
                hits = np.flatnonzero(wanted[at] == found)
                of = np.searchsorted(cuts, p[hits], side="right") - 1
                for k, d in zip(hits.tolist(), of.tolist()):
                    rows.append((ids[d], hashes[d], int(found[k].view(np.int64)), form, int(p[k] - cuts[d]),
                                 _values(words, some, slots, int(p[k]), n)))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())))],
                names=["d", "h", "key", "form", "pos", "slots"])
        _templates().clear()  # workers live on into other stages

    return docs.mapInArrow(step, f"d long, h long, {_ROWS}")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 8, shortest: int = 5, coverage: float = 0.3, text: str = "text",
                 doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(d, h, items): documents that hold benchmark items, by id and xxhash64 of the text, with
    (item_id, share, same) each: the share of the item's windows found under consistent slots, and
    whether all slot values are those of the item.

    A document is contaminated by an item if ``coverage`` of its windows of ``size`` template words
    are found, of all or of those that are not taken literally. Items of less than ``shortest`` words prove nothing and are never found. Benchmark windows are taken in blocks of ``BLOCK_WINDOWS``, whatever their number, so
    that the tasks hold a bounded array of keys; the windows found are joined by key with the block.
    """
    spark = docs.sparkSession
    known = stored(benchmark_windows(benchmark, size, shortest, item_text, item_id), "benchmark")
    blocks = max(1, -(-known.count() // BLOCK_WINDOWS))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("d"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("h"),
        F.col(text).cast("string").alias("t"))
    found = []
    for k in range(blocks):
        block = known.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k)
        held = block.select("key", "n").distinct().collect()
        keys = np.unique(np.array([r[0] for r in held], np.int64).view(np.uint64))
        if len(keys):
            hits = _document_windows(rows, spark.sparkContext.broadcast(keys), sorted({r[1] for r in held}))
            # equal keys have their placeholders at equal places, whatever the form
            theirs = block.select(
                "item_id", "n_windows", "n_free", F.col("key").alias("k1"), (F.col("form") == LITERAL).alias("literal"),
                F.col("pos").alias("at"), F.col("slots").alias("theirs"))
            found.append(hits.join(theirs, F.col("key") == F.col("k1")).select(
                "d", "h", "item_id", "n_windows", "n_free", "literal", "at", (F.col("pos") - F.col("at")).alias("shift"),
                "slots", "theirs"))
    if not found:
        return spark.createDataFrame([], "d long, h long, items array<struct<item_id:long,share:double,same:boolean>>")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    pairs = F.arrays_zip(F.col("theirs").alias("x"), F.col("slots").alias("y"))
    item = ["d", "h", "item_id", "n_windows", "n_free"]
    lines = hits.groupBy(*item, "shift").agg(F.collect_set(F.struct("at", "literal", pairs.alias("p"))).alias("w")).withColumn(
        "pairs", F.array_distinct(F.flatten(F.col("w.p"))))
    # benchmark values that stand for several document values: only what is word for word is left of the line
    values = F.transform("pairs", lambda p: p["x"])
    lines = lines.withColumn("torn", F.array_distinct(F.filter(
        values, lambda x: F.size(F.filter("pairs", lambda p: p["x"] == x)) > 1)))
    word_for_word = lambda w: F.forall(
        w["p"], lambda p: (p["x"] == p["y"]) & ~F.array_contains(F.col("torn"), p["x"]))
    lines = lines.withColumn("w", F.filter("w", lambda w: (F.size("torn") == 0) | word_for_word(w)))
    same = F.forall("pairs", lambda p: p["x"] == p["y"])
    places = lambda w: F.size(F.array_distinct(F.flatten(F.collect_list(F.transform(w, lambda x: x["at"])))))
    shares = lines.filter(F.size("w") > 0).groupBy(*item).agg(
        (places(F.col("w")) / F.col("n_windows")).alias("all"),
        (places(F.filter("w", lambda w: ~w["literal"])) / F.expr("nullif(n_free, 0)")).alias("free"), F.every(same).alias("same"))
    return shares.withColumn("share", F.greatest("all", "free")).filter(F.col("share") >= coverage).groupBy("d", "h").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "share", "same"))).alias("items"))


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The columns of ``docs`` and ``items`` (empty for a clean document); see ``contaminated``.

    Null and empty texts and items match nothing. Null ids and repeated ids are told apart by their
    texts; repeated rows are marked alike. Empty tables give empty or unmarked results. Columns of
    ``docs`` named items are replaced. Texts are used whole.
    """
    keep = [c for c in docs.columns if c != "items"]
    hits = contaminated(docs, benchmark, text=text, doc_id=doc_id, **options)
    h = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return docs.select(packed(keep), F.col(doc_id).cast("long").alias("_d"), h.alias("_h")).join(
        hits, F.col("_d").eqNullSafe(F.col("d")) & (F.col("_h") == F.col("h")), "left").select(
        *unpacked(keep), F.coalesce("items", F.array().cast("array<struct<item_id:long,share:double,same:boolean>>")).alias("items"))
