"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames, each with the number of units (code points) before
it. A place in the text is found by these counts: only the frames that a cut runs through are
decompressed, all others move into the output as they are. Digests stream the frames in order, so a
task holds one decompressed frame at a time, however long the text.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.llm.common import stored

UNITS = 1 << 15  # code points in a frame
LEVEL = 3
FRAME = "struct<first:bigint,units:bigint,data:binary>"
ARROW = pa.list_(pa.struct([("first", pa.int64()), ("units", pa.int64()), ("data", pa.binary())]))
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# the order in which an output holds its parts, each behind its mark
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


class Frames:
    """Reading a text from its ordered frames."""

    def __init__(self, frames, codec: zstandard.ZstdDecompressor):
        self.frames, self.codec = frames or [], codec

    def text(self, frame) -> str:
        return self.codec.decompress(frame["data"]).decode()

    def stream(self) -> Iterator[str]:
        for f in self.frames:
            yield self.text(f)

    def span(self, start: int, stop: int) -> Iterator[dict | str]:
        """Units start to stop: whole frames as they are, cut ones as text."""
        for f in self.frames:
            a, b = max(start, f["first"]), min(stop, f["first"] + f["units"])
            if a < b:
                yield f if b - a == f["units"] else self.text(f)[a - f["first"]:b - f["first"]]

    def marks(self, names) -> list[int]:
        """The first place of each name, looked for in order behind the one before. A name may run
        across the end of a frame."""
        found, left, base = [], "", 0
        names = list(names)
        for piece in self.stream():
            left += piece
            at = 0
            while len(found) < len(names) and (k := left.find(names[len(found)], at)) >= 0:
                found.append(base + k)
                at = k + len(names[len(found) - 1])
            cut = max(at, len(left) - max(map(len, names)) + 1)
            left, base = left[cut:], base + cut
        return found


class Writer:
    """Collects text and whole frames into ordered frames of at most ``units`` code points."""

    def __init__(self, units: int, codec: zstandard.ZstdCompressor):
        self.units, self.codec = units, codec
        self.out, self.open, self.size, self.first = [], [], 0, 0

    def add(self, part: dict | str) -> None:
        if isinstance(part, dict):
            self.close()
            self._put(part["units"], part["data"])
            return
        at = 0
        while at < len(part):
            piece = part[at:at + self.units - self.size]
            self.open.append(piece)
            self.size += len(piece)
            at += len(piece)
            if self.size == self.units:
                self.close()

    def close(self) -> list:
        if self.size:
            self._put(self.size, self.codec.compress("".join(self.open).encode()))
            self.open, self.size = [], 0
        return self.out

    def _put(self, units: int, data: bytes) -> None:
        self.out.append({"first": self.first, "units": units, "data": data})
        self.first += units


def pack(text: Column, units: int = UNITS, level: int = LEVEL) -> Column:
    """The frames of a text; a null or empty text has none."""

    @F.arrow_udf(f"array<{FRAME}>")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = zstandard.ZstdCompressor(level=level)
        for texts in batches:
            rows = []
            for t in texts:
                w = Writer(units, codec)
                w.add(t.as_py() or "")
                rows.append(w.close())
            yield pa.array(rows, ARROW)

    return packed(text)


def reorder(frames: Column, form: Column, start: Column, stop: Column, units: int = UNITS, level: int = LEVEL) -> Column:
    """The frames of the output: the text (form plain), or its three parts, cut at ``start`` and
    ``stop``, behind their marks in the order of the form."""

    @F.arrow_udf(f"array<{FRAME}>")
    def moved(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        read, write = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=level)
        for columns in batches:
            rows = []
            for held, kind, a, b in zip(*columns):
                held, kind = held.as_py() or [], kind.as_py()
                if kind not in ORDERS:
                    rows.append(held)
                    continue
                a, b, n = a.as_py(), b.as_py(), sum(f["units"] for f in held)
                spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
                source, w = Frames(held, read), Writer(units, write)
                for mark in ORDERS[kind]:
                    w.add(mark)
                    for part in source.span(*spans[mark]):
                        w.add(part)
                rows.append(w.close())
            yield pa.array(rows, ARROW)

    return moved(frames, form, start, stop)


def restore(frames: Column, form: Column, units: int = UNITS, level: int = LEVEL) -> Column:
    """The frames of the text that an output was made from, told from the output and its form alone."""

    @F.arrow_udf(f"array<{FRAME}>")
    def rebuilt(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        read, write = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=level)
        for outputs, kinds in batches:
            rows = []
            for held, kind in zip(outputs, kinds):
                held, kind = held.as_py() or [], kind.as_py()
                if kind not in ORDERS:
                    rows.append(held)
                    continue
                source, w = Frames(held, read), Writer(units, write)
                places = source.marks(ORDERS[kind])
                ends = [*places[1:], sum(f["units"] for f in held)]
                spans = {m: (p + len(m), e) for m, p, e in zip(ORDERS[kind], places, ends)}
                for mark in (PREFIX, MIDDLE, SUFFIX):
                    for part in source.span(*spans[mark]):
                        w.add(part)
                rows.append(w.close())
            yield pa.array(rows, ARROW)

    return rebuilt(frames, form)


def sha256(frames: Column) -> Column:
    """Lowercase hex of the sha256 of the text in UTF-8, frame by frame."""

    @F.arrow_udf("string")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = zstandard.ZstdDecompressor()
        for column in batches:
            rows = []
            for held in column:
                sha = hashlib.sha256()
                for f in held.as_py() or []:
                    sha.update(codec.decompress(f["data"]))
                rows.append(sha.hexdigest())
            yield pa.array(rows, pa.string())

    return hashed(frames)


def unpack(frames: Column) -> Column:
    """The text of the frames."""

    @F.arrow_udf("string")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = zstandard.ZstdDecompressor()
        for column in batches:
            yield pa.array(["".join(Frames(x.as_py(), codec).stream()) for x in column], pa.string())

    return joined(frames)


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", plain_from: int = 90,
                   spm_below: int = 20, units: int = UNITS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``; ``output`` are
    the frames of the transformed text (``unpack`` gives the text, ``restore`` the original).

    h1 to h4 are the first four groups of 8 digits of the sha256 of "1:" and the id. The text of n
    code points is cut behind h1 % (n + 1) and h2 % (n + 1) units. The form is plain for an empty text,
    one that holds a mark, and where h3 % 100 >= ``plain_from``; else spm where h4 % 100 <
    ``spm_below``, else psm. In form plain both lengths are null.

    Null texts are empty; a null id counts as an empty string. Rows are independent: repeated rows
    repeat, other columns of ``docs`` are not read, an empty table gives an empty result. The frames
    are stored once in the shared folder; nothing is shuffled.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    cut = [F.pmod(x, F.col("n") + 1) for x in h[:2]]
    marked = t.contains(PREFIX) | t.contains(SUFFIX) | t.contains(MIDDLE)
    # a udf is planned before the columns beside it, so the frames are made first
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest.alias("_h"), F.length(t).cast("long").alias("n"),
                       marked.alias("_marked"), pack(t, units).alias("frames"))
    plain = (F.col("n") == 0) | F.col("_marked") | (F.pmod(h[2], F.lit(100)) >= plain_from)
    rows = stored(rows.select(
        "doc_id", "n", F.when(plain, "plain").when(F.pmod(h[3], F.lit(100)) < spm_below, "spm").otherwise("psm").alias("form"),
        F.least(*cut).alias("_a"), F.greatest(*cut).alias("_b"), "frames"), "frames")
    kept = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(kept, F.col("_a")).alias("prefix_chars"),
        F.when(kept, F.col("_b") - F.col("_a")).alias("middle_chars"),
        reorder(F.col("frames"), F.col("form"), F.col("_a"), F.col("_b"), units).alias("output"))


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` with output_sha256 and restored_sha256 in place of ``output``: the hashes of the output
    and of the text rebuilt from it."""
    return rows.select(
        *[c for c in rows.columns if c != "output"], sha256(F.col("output")).alias("output_sha256"),
        sha256(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
