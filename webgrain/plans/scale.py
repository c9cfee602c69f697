"""Building blocks that keep plans balanced: materialising, ranking without one big window,
top-n with map-side limits.

Nothing here puts a whole table or a whole group into one task. Numbering and running sums go
through range partitions: a group with a third of the rows is cut into as many partitions as
it needs, and only one offset per partition is joined back.
"""

import tempfile
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

_local_dirs = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Where it is unset, only a local master may fall back on a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="webgrain-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors,
    and keeps column pruning for the readers."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short list as a table whose size the planner knows, so that it is broadcast where it
    fits and never makes the other side shuffle."""
    shape = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], schema)
    cells = F.array(*[
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, shape)])
        for row in rows
    ])
    return spark.range(1, numPartitions=1).select(F.inline(cells))


def _sorted_parts(df, by, order, label):
    """Range-partitioned by (by, order), with the partition number and the row's place in it."""
    keys = [*by, *order]
    return materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_seq", F.monotonically_increasing_id()),
        label,
    ).select(
        "*",
        F.shiftright("_seq", 33).alias("_part"),
        F.col("_seq").bitwiseAND((1 << 33) - 1).alias("_local"),
    )


def global_index(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Number all rows in ``order`` (make it unique) from ``start``.

    One range shuffle; the counts per partition give the offsets, at most one row per
    partition, so that side is broadcast.
    """
    base = _sorted_parts(df, [], order, "index")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        base.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        base.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_local") + F.lit(start).cast("long"))
        .drop("_part", "_seq", "_local", "_offset")
    )


def _local_sums(sums):
    """Running sums over sorted rows, started anew where the group (``_g``) changes; a partition is
    read batch by batch and only the last group's sums are carried over."""

    def run(batches):
        group, carry, place = None, {}, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = np.asarray(batch.column(batch.schema.get_field_index("_g")))
            new = np.ones(n, bool)
            new[1:] = g[1:] != g[:-1]
            new[0] = place == 0 or g[0] != group
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            added = []
            for c in sums:
                x = batch.column(batch.schema.get_field_index(c))
                x = np.nan_to_num(x.to_numpy(zero_copy_only=False)) if x.null_count else np.asarray(x)
                upto = np.concatenate([[0], np.cumsum(x)])
                before = upto[:-1] - np.where(start >= 0, upto[np.maximum(start, 0)], -carry.get(c, 0))
                added.append(pa.array(before, batch.schema.field(c).type))
                carry[c] = before[-1] + x[-1]
            group = g[-1]
            local = pa.array(np.arange(place, place + n, dtype=np.int64))
            place += n
            part = pa.array(np.full(n, TaskContext.get().partitionId(), np.int32))
            yield pa.record_batch(
                [*batch.columns, *added, part, local],
                names=[*batch.schema.names, *[f"_l_{c}" for c in sums], "_part", "_local"])

    return run


def running_totals(df: DataFrame, by: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``<c>_before`` for each c in ``sums``: the sum of c over the earlier rows of the
    same ``by`` group (``order`` unique within the group; null counts as 0).

    One range shuffle by (by, order) and one write. The sums run inside each partition; only the
    first group of a partition can have started in an earlier one, so the offsets are at most one
    row per partition (broadcast).
    """
    typed = df.select("*", *[F.col(c).cast("double" if dict(df.dtypes)[c] in ("float", "double") else "long")
                             .alias(f"_v_{c}") for c in sums])
    values = [f"_v_{c}" for c in sums]
    keys = [*by, *order]
    inner = typed.withColumn("_g", F.xxhash64(*by)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = StructType([
        *inner.schema.fields, *[StructField(f"_l_{v}", inner.schema[v].dataType) for v in values],
        StructField("_part", IntegerType()), StructField("_local", LongType())])
    base = materialize(inner.mapInArrow(_local_sums(values), schema), "totals")
    earlier = (
        Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        base.groupBy("_part", *by)
        .agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
        .select(
            F.col("_part").alias("_p"),
            *[F.col(k).alias(f"_k_{k}") for k in by],
            *[F.sum(f"_s_{v}").over(earlier).alias(f"_o_{v}") for v in values],
        )
        .filter(reduce(lambda a, b: a | b, [F.col(f"_o_{v}").isNotNull() for v in values]))
    )
    match = reduce(
        lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_k_{k}")), by, F.col("_part") == F.col("_p")
    )
    return base.join(F.broadcast(offsets), match, "left").select(
        *df.columns,
        *[(F.col(f"_l_{v}") + F.coalesce(F.col(f"_o_{v}"), F.lit(0))).alias(f"{c}_before")
          for c, v in zip(sums, values)],
    )


def top_n_per_key(df: DataFrame, keys: list, order: list, n: int) -> DataFrame:
    """First n rows per key (null keys form one group).

    The planner limits each key inside every input partition before the shuffle, up to the n of
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000; raise it for more), so a hot key
    moves n rows per partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(f"_rn <= {n}").drop("_rn")
