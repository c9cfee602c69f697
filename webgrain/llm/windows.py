"""Fingerprints of windows and content-picked anchors over whole batches of documents (numpy).

A batch is one long array of units (words or bytes) with the offsets of its documents. All functions
work on the long array; windows that would cross the end of a document are marked as invalid.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text that is worked on at a time; a longer text is a slice of its own

_B = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling fingerprints
_C = np.uint64(0xC2B2AE3D27D4EB4F)  # of a second, independent one


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches, *columns: str):
    """The batches cut by the bytes of some text columns: the arrays made from a slice are tens of
    times its size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(c))), 0)).astype(
            np.int64) for c in columns)
        part = np.cumsum(lengths) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of the documents. Null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n, first = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[first:first + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def fingerprints(units: np.ndarray, n: int, base: np.uint64 = _B) -> np.ndarray:
    """Rolling fingerprint of every n units, by doubling: a window of 2m is two windows of m. The
    last n - 1 entries are meaningless."""
    out, done, part, size = None, 0, units, 1
    while True:
        if n & size:
            out, done = (part, size) if out is None else (shifted_sum(part, out, size, base), done + size)
        if size * 2 > n:
            return out
        part, size = shifted_sum(part, part, size, base), size * 2


def shifted_sum(a: np.ndarray, b: np.ndarray, n: int, base: np.uint64 = _B) -> np.ndarray:
    """Fingerprint of a window of n (``a``) followed by the window of ``b`` behind it."""
    out = a.copy()
    out[:max(0, len(a) - n)] += _power(base, n) * b[n:]
    return out


def word_units(raw: np.ndarray, offsets: np.ndarray):
    """Words of all documents: fingerprints (uint64), start and end byte of each, and the offsets of
    the documents in words."""
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    word = ~blank
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    counts = np.searchsorted(starts, offsets)
    # polynomial of the word's bytes, from differences of prefix sums
    powers = np.empty(len(raw) + 1, np.uint64)
    powers[0] = 1
    powers[1:] = _C
    np.multiply.accumulate(powers, out=powers)
    inverse = np.uint64(pow(int(_C), -1, 1 << 64))
    back = np.empty(len(raw) + 1, np.uint64)
    back[0] = 1
    back[1:] = inverse
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.add.accumulate(mixed(raw.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    prints = (sums[ends] - sums[starts]) * back[starts]
    return mixed(prints + (ends - starts).astype(np.uint64) * _B), starts, ends, counts


def room(offsets: np.ndarray, size: int) -> np.ndarray:
    """For each unit: units to the end of its document, itself included."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return ends - np.arange(size)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each place p the leftmost place of the least value in p .. p + width - 1 (cut off at the
    end of the array), by doubling. Values are compared by their upper 40 bits."""
    high, n = values >> np.uint64(24), len(values)
    if n < 1 << 24:  # value and place in one number
        least, size = (high << np.uint64(24)) | np.arange(n, dtype=np.uint64), 1
        while size < width:
            step = min(size, width - size)
            if step < n:
                least = np.append(np.minimum(least[:-step], least[step:]), least[-step:])
            size += step
        return (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    at, size = np.arange(n, dtype=np.int64), 1
    while size < width:
        step = min(size, width - size)
        other = at[np.minimum(np.arange(n) + step, n - 1)]
        at, size = np.where(high[other] < high[at], other, at), size + step
    return at


def anchors(prints: np.ndarray, left: np.ndarray, window: int, gram: int):
    """The anchor of a window is its leftmost unit sequence of ``gram`` units with the least
    scrambled fingerprint: equal windows have equal anchors at equal places. Returns, per anchor
    and in order, its place and the first and last start of the windows it stands for."""
    at = leftmost_minima(mixed(prints), window - gram + 1)
    whole = np.flatnonzero(left >= window)
    if not len(whole):
        none = np.zeros(0, np.int64)
        return none, none, none
    picked = at[whole]
    new = np.empty(len(whole), bool)
    new[0] = True
    new[1:] = (picked[1:] != picked[:-1]) | (whole[1:] != whole[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(whole)) - 1
    return picked[first], whole[first], whole[last]
