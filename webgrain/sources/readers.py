"""Readers. Schemas are given, never inferred; missing places give empty tables."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrain.functions.strings import http_body
from webgrain.lookups import CAPTURE_SNAPSHOTS

# --- fixed values: cells read as missing ---
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# -------------------------------------------

PIECE = 1 << 20  # bytes of decoded records that a Python worker hands back at a time
_LISTING = "path string, length bigint, mtime timestamp"


def read_csv(spark: SparkSession, path: str, schema: str, null_tokens=tuple(NULL_TOKENS),
             line_breaks: bool = False) -> DataFrame:
    """CSV with header; every cell spelled like a missing value becomes null.

    Cells are read as text and cast, so that the tokens work for all types. Large files are split;
    with ``line_breaks`` inside quoted cells a file is one task.
    """
    wanted = spark.createDataFrame([], schema).schema
    texts = ", ".join(f"`{f.name}` string" for f in wanted)
    raw = spark.read.schema(texts).csv(path, header=True, multiLine=line_breaks, escape='"')
    return raw.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*null_tokens), F.col(f"`{f.name}`"))
        .cast(f.dataType).alias(f.name)
        for f in wanted
    ])


def scan_captures(spark: SparkSession, path: str, url_prefix: str,
                  crawls=tuple(CAPTURE_SNAPSHOTS)) -> DataFrame:
    """Capture index (parquet, partitioned by ``crawl``): chosen snapshots, one URL prefix.
    Both tests are plain comparisons, so partitions and row groups are skipped."""
    return spark.read.parquet(path).filter(
        F.col("crawl").isin(*crawls) & F.col("url").startswith(url_prefix)
    )


def in_pieces(values, kind, most: int = PIECE):
    """Binary values as arrays of about ``most`` bytes, so that no more than these are held at a time."""
    held, size = [], 0
    for v in values:
        held.append(v)
        size += len(v or b"")
        if size >= most:
            yield pa.array(held, kind)
            held, size = [], 0
    if held:
        yield pa.array(held, kind)


def gunzip(payload: Column) -> Column:
    """Gzip member(s) to bytes; null when damaged."""
    import gzip
    import zlib

    def one(v):
        try:
            return gzip.decompress(v.as_buffer()) if v.is_valid else None
        except (OSError, EOFError, zlib.error):
            return None

    @F.arrow_udf("binary")
    def _gunzip(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in values:
            yield from in_pieces((one(v) for v in batch), pa.binary())

    return _gunzip.asNondeterministic()(payload)


def _place(column: str | Column) -> Column:
    """A place inside a row's payload; null for what no payload can hold (2 GB), so that the row is empty."""
    at = (F.col(column) if isinstance(column, str) else column).try_cast("bigint")
    return F.when(at.between(0, (1 << 31) - 2), at.cast("int"))


def decode_records(df: DataFrame, payload: str = "payload", offset: str | None = None,
                   length: str | None = None, name: str = "data") -> DataFrame:
    """Add the decoded text of a gzip record, cut from the payload when offset and length
    (text or numbers) are named. Bytes that are no UTF-8 give ``""``."""
    member = F.col(payload)
    if offset is not None:
        member = F.substring(member, _place(offset) + 1, _place(length))
    text = F.try_validate_utf8(gunzip(member).cast("string"))
    return df.withColumn(name, F.coalesce(text, F.lit(""))).drop(payload)


def cut_ranges(wanted: DataFrame, files: DataFrame, on: str, payload: str = "payload",
               offset: str = "offset", length: str = "length") -> DataFrame:
    """Rows of ``wanted`` with their byte range of the file as ``payload``.

    The ranges wanted of a file are gathered first (no more than it has records) and cut inside the
    file's row, so that a payload is moved once, however many ranges are read from it. Files nothing
    is wanted of drop out in the join.
    """
    asked = wanted.groupBy(on).agg(F.collect_list(F.struct(*wanted.columns)).alias("_ranges"))

    def piece(r):
        start, size = _place(r[offset]), _place(r[length])
        return F.struct(r.alias("row"), F.substring(F.col(payload), start + 1, size).alias(payload))

    cut = files.select(on, payload).join(asked, on).select(F.explode(F.transform("_ranges", piece)).alias("_x"))
    return cut.select("_x.row.*", F.col(f"_x.{payload}").alias(payload))


def read_bodies(df: DataFrame, **where) -> DataFrame:
    """Decode records and keep the part after both header blocks as ``html``."""
    return decode_records(df, **where).withColumn("html", http_body(F.col("data"))).drop("data")


def list_files(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """(path, length, mtime) of all files below a place; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(prefix)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTING)
    return files.select("path", "length", F.col("modificationTime").alias("mtime"))


def scan_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Pixel table (path, y, x, r, g, b) of the images below a place."""
    image = spark.read.format("image").option("dropInvalid", "true").load(path).select("image.*")
    cell = F.posexplode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("_i", "_j")
    grid = image.select(
        F.col("origin").alias("path"), "width", "data", F.col("nChannels").alias("c"), cell)

    def channel(k):  # stored as b, g, r(, a); one channel means gray
        at = F.col("_i") * F.col("c") + F.when(F.col("c") > 1, F.lit(k)).otherwise(F.lit(0)) + 1
        return F.conv(F.hex(F.substring("data", at, F.lit(1))), 16, 10).cast("int")

    return grid.select(
        "path", F.floor(F.col("_i") / F.col("width")).cast("int").alias("y"),
        (F.col("_i") % F.col("width")).alias("x"),
        channel(2).alias("r"), channel(1).alias("g"), channel(0).alias("b"),
    )
