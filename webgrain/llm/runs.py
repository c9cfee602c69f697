"""Runs of periodically repeated words, by seeds on diagonals.

Words that equal the word q places on form a diagonal of lag q. A run of period q with an exponent of
four or more holds at least 3q such words in a row, so for the periods from 2^j to 2^(j+1) - 1 every
run holds two equal k-grams, k = 3 * 2^j, at distance q: k is the overlap that is guaranteed at least.
The k-grams of a document are indexed by exact names (a gram of 2k words is a pair of ranks of k) and
the occurrence pairs of a gram give the seeds. As k is at least q - 1, a pair inside a run with an
occurrence between would give the run a smaller period (theorem of Fine and Wilf); so neighbouring
occurrences are the only pairs that are enumerated: at most one per word and level. A seed is
extended along its diagonal in both directions; a table of the furthest covered place per lag skips
the seeds of a stretch that was already extended.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain.llm import windows as W
from webgrain.llm.common import words

FOLD = 4  # least exponent of a run
LEAST = 6  # and its least length
RUN = "struct<start:bigint,length:bigint,period:bigint>"
ARROW = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])


class Grams:
    """The k-grams of one array of word numbers. A gram is named by a number, equal for equal grams of
    the same length; ``room`` are the words from a place to the end of its document."""

    def __init__(self, units: np.ndarray, room: np.ndarray):
        self.units, self.room = units, room

    def named(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and names of all k-grams, word by word."""
        at = np.flatnonzero(self.room >= k)
        count = int(self.units.max(initial=0)) + 1
        name, n = self.units[at], count
        for j in range(1, k):
            if n * count >= 1 << 62:
                name = _ranks(name)
                n = len(name) + 1
            name, n = name * count + self.units[at + j], n * count
        return at, name

    def doubled(self, at: np.ndarray, name: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and names of the 2k-grams whose halves are among the given k-grams (places ascending)."""
        if not len(at):
            return at, name
        rank = _ranks(name)
        behind = np.searchsorted(at, at + k)
        behind[behind == len(at)] = 0
        whole = (at[behind] == at + k) & (self.room[at] >= 2 * k)
        return at[whole], rank[whole] * (int(rank.max()) + 1) + rank[behind[whole]]


def _ranks(names: np.ndarray) -> np.ndarray:
    return np.unique(names, return_inverse=True)[1]


def seeds(doc: np.ndarray, at: np.ndarray, name: np.ndarray):
    """Neighbouring occurrences (place, lag) of equal grams in a document, and the places whose gram
    occurs again in the document at all."""
    order = np.argsort(name, kind="stable")
    place, kind = at[order], name[order]
    again = (kind[1:] == kind[:-1]) & (doc[place[1:]] == doc[place[:-1]])
    left = place[:-1][again]
    lag = place[1:][again] - left
    some = np.zeros(len(place), bool)
    some[:-1] |= again
    some[1:] |= again
    keep = np.zeros(len(at), bool)
    keep[order[some]] = True
    return left, lag, keep


def _stretch(units: np.ndarray, i: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around i of words that equal the word ``lag`` on, inside low .. high."""
    end, step = i, 64
    while end + lag < high:
        size = min(step, high - lag - end)
        differ = np.flatnonzero(units[end:end + size] != units[end + lag:end + lag + size])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + size, step * 2
    start, step = i, 64
    while start > low:
        size = min(step, start - low)
        differ = np.flatnonzero(units[start - size:start] != units[start - size + lag:start + lag])
        if len(differ):
            start += int(differ[-1]) + 1 - size
            break
        start, step = start - size, step * 2
    return start, end


def find_runs(units: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period, in one long array of word numbers;
    runs never cross the offsets of the documents."""
    n = len(units)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    grams, found = Grams(units, W.room(offsets, n)), []
    longest = int(np.diff(offsets).max(initial=0))
    k, low, high = FOLD - 1, 1, 2
    at, name = grams.named(k)
    while len(at) and FOLD * low <= longest:
        left, lag, keep = seeds(doc, at, name)
        near = (lag >= low) & (lag < high)
        left, lag = left[near], lag[near]
        order = np.lexsort((left, lag))
        left, lag = left[order], lag[order]
        # seeds that follow each other lie on one stretch
        head = np.ones(len(left), bool)
        head[1:] = (left[1:] != left[:-1] + 1) | (lag[1:] != lag[:-1])
        covered: dict[int, int] = {}
        for i, q in zip(left[head].tolist(), lag[head].tolist()):
            if i < covered.get(q, -1):
                continue
            start, end = _stretch(units, i, q, int(offsets[doc[i]]), int(offsets[doc[i] + 1]))
            covered[q] = end
            if end + q - start >= max(LEAST, FOLD * q):
                found.append((start, end + q - start, q))
        at, name = grams.doubled(at[keep], name[keep], k)
        k, low, high = 2 * k, high, 2 * high
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbered(text: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, equal for equal words."""
    table: dict[bytes, int] = {}
    return np.array([table.setdefault(w, len(table)) for ws in text for w in ws], np.int64)


def collapse_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    A run is a stretch of words (parted by space and the characters from tab to carriage return) with
    smallest period q and a length of at least max(6, 4q) that neither neighbour continues. ``runs``
    are all (start, length, period), by start, then period. ``collapsed`` are the words joined by one
    space, without those that a run holds behind its first period.

    Null and empty texts have no words and no runs. Rows are independent: repeated rows repeat, other
    columns of ``docs`` are not read, an empty table gives an empty result. Texts of any length are used
    whole; a task works on a few MB of text at a time, or on one longer text. Nothing is shuffled.
    """

    def step(batches):
        for batch in W.slices(batches, "_t"):
            texts = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            runs = find_runs(_numbered(texts), offsets)
            gone = np.zeros(offsets[-1] + 1, np.int64)
            for start, length, period in runs:
                gone[start + period] += 1
                gone[start + length] -= 1
            gone = np.cumsum(gone) > 0
            cuts = np.searchsorted([r[0] for r in runs], offsets)
            out = []
            for d, (t, a) in enumerate(zip(texts, offsets[:-1].tolist())):
                own = [{"start": s - a, "length": m, "period": q} for s, m, q in runs[cuts[d]:cuts[d + 1]]]
                kept = [t[i] for i in np.flatnonzero(~gone[a:a + len(t)])] if own else t
                out.append((len(t), own, b" ".join(kept).decode()))
            yield pa.record_batch(
                [batch.column(0), *[pa.array([x[c] for x in out], kind) for c, kind in enumerate(
                    (pa.int64(), pa.list_(ARROW), pa.string()))]],
                names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    return rows.mapInArrow(step, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones that with the smallest
    start, then period. Null without runs."""
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda a, x: F.when(
        x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed per run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def planted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (doc_id, text) where one document in ten ends in a run: with h the crc32 of the id, g =
    h / 10 and n words, if h % 10 = 0 each word i from a = g % n on is word a + (i - a) % p, with
    p = 1 + (n - a) / (3 + g % 8). A null id counts as an empty text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    h = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(F.col("_h") / 10)

    def cut(w):
        n = F.size(w).cast("long")
        return let(F.struct((g % n).alias("a"), n.alias("n")), lambda x: let(
            (F.lit(1) + F.floor((x["n"] - x["a"]) / (F.lit(3) + g % 8))).cast("long"), lambda p: F.array_join(F.transform(
                w, lambda v, i: F.when(i < x["a"], v).otherwise(F.get(w, (x["a"] + (i - x["a"]) % p).cast("int")))), " ")))

    changed = let(words(F.col("_t")), lambda w: F.when(F.size(w) > 0, cut(w)).otherwise(F.col("_t")))
    return docs.select(F.col(doc_id).alias("doc_id"), t.alias("_t"), h.alias("_h")).select(
        "doc_id", F.when(F.col("_h") % 10 == 0, changed).otherwise(F.col("_t")).alias("text"))
