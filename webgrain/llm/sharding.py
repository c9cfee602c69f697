"""Sharding of documents by histogram sort.

The rows are put in the order of a key and cut into shards of nearly equal bytes. The splitters are
found as in a histogram sort: every round counts the exact bytes below candidate boundaries in all
partitions at once, and the next round probes only the brackets that hold a wanted byte offset,
until every splitter is within the tolerance. Then the rows are exchanged once.
Built-in functions only.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webgrain.llm.common import stored

PROBE_BITS = 8  # candidate boundaries per bracket and round: 2 ** 8
ROW_BYTES = 8


def _digits(word, shift):
    """``PROBE_BITS`` bits of a signed 64-bit key, in its order as an unsigned number."""
    return F.shiftrightunsigned(word, shift).bitwiseAND((1 << PROBE_BITS) - 1)


def _key_digits():
    """The key as digits from the highest: hash of the text (equal texts are neighbours), doc_id,
    place in the stored table (repeated rows)."""
    words = [F.col("_h"), F.col("_d"), F.col("_seq")]
    return [_digits(w, s) for w in words for s in range(64 - PROBE_BITS, -1, -PROBE_BITS)]


def find_splitters(keyed: DataFrame, weight: str, shards: int, tolerance: float) -> list[tuple]:
    """For each inner boundary the digits of a key: rows below it come before the cut.

    A round is one aggregation: bytes per (bracket, digit), at most ``(shards - 1) * 2 ** PROBE_BITS``
    rows to the driver whatever the input. A bracket is settled when a candidate boundary is within
    ``tolerance`` of a shard's bytes, or when at most one row lies between two candidates.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    digits = _key_digits()
    wanted = {k: total * k / shards for k in range(1, shards)}
    slack = tolerance * total / shards
    open_at = {(): (0, list(wanted))}  # bracket prefix -> (bytes below the bracket, open cuts)
    found = {}
    for depth, digit in enumerate(digits):
        if not open_at:
            break
        rows = keyed
        if depth:
            prefix = F.array(*digits[:depth])
            at = reduce(lambda a, b: a | b, [
                prefix == F.array(*[F.lit(x).cast("long") for x in p]) for p in open_at])
            rows = keyed.filter(at).withColumn("_p", prefix)
        else:
            rows = keyed.withColumn("_p", F.array().cast("array<bigint>"))
        counts = {}
        for p, d, size, n in rows.groupBy("_p", digit.alias("_digit")).agg(F.sum(weight), F.count("*")).collect():
            counts.setdefault(tuple(p), {})[d] = size, n
        following = {}
        for p, (below, cuts) in open_at.items():
            at, bounds = below, [((*p, 0), below, 0, 0)]
            for d, (size, n) in sorted(counts.get(p, {}).items()):
                bounds += [((*p, d), at, size, n), ((*p, d + 1), at + size, 0, 0)]
                at += size
            bounds.append(((*p, 1 << PROBE_BITS), at, 0, 0))
            for cut in cuts:
                key, gap = min(((k, abs(b - wanted[cut])) for k, b, _, _ in bounds), key=lambda x: x[1])
                inside = [(k, b) for k, b, size, n in bounds if n > 1 and b < wanted[cut] < b + size]
                if gap <= slack or not inside or depth + 1 == len(digits):
                    found[cut] = key
                else:
                    k, b = inside[0]
                    following.setdefault(k, (b, []))[1].append(cut)
        open_at = following
    return [found[k] for k in sorted(found)]


def _below(splitter):
    """Whether a row's key is below a splitter, compared digit by digit."""
    digits = _key_digits()[:len(splitter)]
    test = F.lit(False)
    for d, s in reversed(list(zip(digits, splitter))):
        test = (d < s) | ((d == s) & test)
    return test


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.001, rows_per_task: int = 1_000_000,
          text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``bytes``: the sizes of the shards differ by no more than ``tolerance`` of a shard on either
    side of a cut, or by one row where a row is larger. ``size`` is the UTF-8 bytes of the text
    (null: none) plus 8. Groups of equal texts are neighbours in the key; only a group that a cut
    meets is parted, so a group larger than a shard fills several. Slots are gapless from 0.
    Null ids sort first; repeated rows each get a slot. An empty table gives an empty result. Other
    columns of ``docs`` are not read.

    The texts are read once, into a narrow stored table that all rounds count. The one exchange
    puts a shard into as many tasks as it has ``rows_per_task``; the slots of a task start behind
    the counts of the tasks before it (a table of one row per task, counted from the stored keys).
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = stored(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(t).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("_h"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).bitwiseXOR(F.lit(-(1 << 63))).alias("_d"),
        F.monotonically_increasing_id().alias("_seq"),
    ), "shard-keys")
    cuts = find_splitters(keyed, "size", shards, tolerance)
    tasks = max(1, -(-keyed.count() // (rows_per_task * shards)))
    placed = keyed.withColumn(
        "shard", sum((F.when(_below(c), 0).otherwise(1) for c in cuts), F.lit(0)).cast("int")
    ).withColumn("_task", F.pmod(F.xxhash64("doc_id", "_seq"), F.lit(tasks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "_task").agg(F.count("*").alias("_n"))
        .select("shard", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("shard", "_task").orderBy("_h", "_d", "_seq")
    return (
        placed.withColumn("_slot", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "_task"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("_start") + F.col("_slot")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard")))
