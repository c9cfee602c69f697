"""Substring dedup by level-wise doubling.

Windows that are repeated at one length are extended to twice that length, all others are dropped;
this goes on to the wanted length or until no candidate survives. See ``repeats`` for how windows
are picked at the first level and compared at the last.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from webgrain.llm.repeats import NULL_ID, Finder, Texts, identified, removal_mask
from webgrain.llm.windows import slices, text_bytes, word_units


def levels(window: int, start: int) -> list[int]:
    """Lengths from ``start`` on, doubled as long as a window holds such a sequence on one side or
    the other of any anchor."""
    found = [start]
    while found[-1] * 2 < window and found[-1] * 4 <= window + start:
        found.append(found[-1] * 2)
    return found


def dedup_substrings(docs: DataFrame, window: int = 20, start: int = 5, text: str = "text",
                     doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, kept_text, n_words, n_removed, kept_sha256) for every row of ``docs``: each word that
    is covered by a window of ``window`` words which also starts earlier (smaller id, or earlier in
    the same document) is removed; windows are judged on the input. ``kept_text`` is the kept words
    joined by one space, ``kept_sha256`` the hash of its UTF-8 bytes.

    Words are parted by space and the characters from tab to carriage return. Null and empty texts
    have no words. A null id comes after all others; rows with equal ids are ordered by the hash of
    their text, and rows equal in both are one document: each gets its result. Texts of any length
    are used whole. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    if not 0 < start <= window:
        raise ValueError("start must be between 1 and window")
    finder = Finder(window, levels(window, start), of_words=True)

    def kept(batches):
        for batch in slices(batches, "_t"):
            texts = Texts(batch, finder)
            gone = removal_mask(*finder.removed(texts), len(texts.units))
            raw, offsets = text_bytes(batch.column(batch.schema.get_field_index("_t")))
            _, starts, ends, counts = word_units(raw, offsets)
            data = raw.tobytes()
            out = []
            for d, first, end in zip(batch.column(1).to_pylist(), counts[:-1], counts[1:]):
                stay = np.flatnonzero(~gone[first:end]) + first
                rest = b" ".join([data[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])
                out.append((None if d == NULL_ID else d, rest.decode(), int(end - first),
                            int(end - first) - len(stay), hashlib.sha256(rest).hexdigest()))
            yield pa.record_batch(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(
                    (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["doc_id", "kept_text", "n_words", "n_removed", "kept_sha256"])

    return finder.compared(identified(docs, text, doc_id)).mapInArrow(
        kept, "doc_id long, kept_text string, n_words long, n_removed long, kept_sha256 string")
