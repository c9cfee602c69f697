"""Streaming operators. Each takes and returns a streaming DataFrame; the caller chooses output
mode, sink and trigger.

``TIMESTAMP_NTZ`` columns are cast to timestamps (session zone UTC), since watermarks need them.
"""

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from webgrain.lookups import DOMAIN_CAP
from webgrain.plans.scale import top_n_per_key


def read_stream(spark: SparkSession, folder: str, glob: str, files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, schema taken from the files there. With ``files``, folders
    below it are read too, oldest files first, at most that many in a micro-batch."""
    options = {"pathGlobFilter": glob}
    if files:
        options["recursiveFileLookup"] = "true"
    schema = spark.read.options(**options).parquet(folder).schema
    if files:
        options["maxFilesPerTrigger"] = str(files)
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def replay(df: DataFrame, ts: str, parts: int, path: str) -> str:
    """Write a table as a feed: ``parts`` files of about as many rows, one after the other in the order
    of ``ts`` (equal times stay together, null times come first)."""
    cuts = df.agg(F.percentile_approx(ts, [i / parts for i in range(1, parts)], 10000)).first()[0] or []
    part = sum((F.when(F.col(ts) > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    for i in range(parts):
        df.filter(F.coalesce(part, F.lit(0)) == i).coalesce(1).write.parquet(f"{path}/part-{i:04d}")
    return path


def sessions(df: DataFrame, key: str, gap: str, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """(key, session_start, last_event, n): activity until a pause longer than ``gap``. An event
    exactly ``gap`` after the last one still belongs to the session. The session setting that merges
    sessions in front of the shuffle (``session.SETTINGS``) keeps a hot key narrow."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if delay:
        timed = timed.withWatermark(ts, delay)
    return (
        timed.groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(F.max(ts).alias("last_event"), F.count("*").alias("n"))
        .select(key, F.col("w.start").alias("session_start"), "last_event", "n")
    )


def rate_flags(df: DataFrame, key: str, n: int, seconds: int, ts: str = "ts",
               delay: str | None = None) -> DataFrame:
    """(key, window_start, n, over): requests per window and whether they exceed the rate."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if delay:
        timed = timed.withWatermark(ts, delay)
    return (
        timed.groupBy(key, F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(F.count("*").alias("n"))
        .select(key, F.col("w.start").alias("window_start"), "n", (F.col("n") > n).alias("over"))
    )


def _precut(df, key, order, n, ts=None):
    """At most n rows per key from each batch of a task, lowest ``order`` first, so that a hot key is
    thinned out before the shuffle; with ``ts``, also its latest row. Nothing is held from one batch to
    the next."""

    def run(batches):
        for pdf in batches:
            ordered = pdf.sort_values(order, kind="stable").reset_index(drop=True)
            keep = ordered.groupby(key, sort=False, dropna=False).cumcount() < n
            if ts:
                timed = ordered[ordered[ts].notna()]
                keep |= ordered.index.isin(timed.groupby(key, sort=False, dropna=False)[ts].idxmax())
            yield ordered[keep]

    return df.mapInPandas(run, df.schema)


class _Cap(StatefulProcessor):
    """One counter per key and, where keys are forgotten, the time of its latest row, with one timer."""

    def __init__(self, order, n, columns, ts, idle_ms):
        self.order, self.n, self.columns, self.ts, self.idle_ms = order, n, columns, ts, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.used = handle.getValueState("used", "used int, last long")

    def handleInputRows(self, key, rows, timerValues):
        used, last = self.used.get() if self.used.exists() else (0, None)
        best, seen = None, last
        for pdf in rows:
            if self.idle_ms:
                times = pdf[self.ts].dropna()
                seen = max([int(times.max().timestamp() * 1000)] * bool(len(times)) + [seen] * (seen is not None), default=None)
            if used < self.n:
                parts = [pdf] if best is None else [best, pdf]
                best = pd.concat(parts).sort_values(self.order, kind="stable").head(self.n - used)
        if seen != last:
            if last is not None:
                self.handle.deleteTimer(last + self.idle_ms)
            self.handle.registerTimer(seen + self.idle_ms)
        self.used.update((used + (0 if best is None else len(best)), seen))
        if best is not None:
            yield best[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.used.clear()
        yield from ()

    def close(self) -> None:
        pass


def cap_stream(df: DataFrame, key: str, order: list[str], n: int = DOMAIN_CAP, ts: str | None = None,
               idle_seconds: float | None = None, delay: str = "0 seconds") -> DataFrame:
    """First n rows per key over the life of the stream (within a micro-batch by ``order``).

    State is one counter per key. With ``idle_seconds`` a key is forgotten, and counted from nothing
    again, when the watermark (``delay`` behind the column ``ts``) has passed its latest row by that
    time; rows behind the watermark are dropped then.
    """
    if not idle_seconds:
        return _precut(df, key, order, n).groupBy(key).transformWithStateInPandas(
            _Cap(order, n, df.columns, None, 0), df.schema, "append", "none")
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    cut = _precut(timed, key, order, n, ts).withWatermark(ts, delay)
    return cut.groupBy(key).transformWithStateInPandas(
        _Cap(order, n, df.columns, ts, round(idle_seconds * 1000)), timed.schema, "append", "eventTime")


class _Sessions(StatefulProcessor):
    """The open sessions of the keys of a bucket (key, start, last, rows; times in microseconds), pickled in
    one value, and one timer: a millisecond behind the last moment at which a row may still continue the
    session that ends first."""

    def __init__(self, key, gap_us):
        self.key, self.gap_us = key, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "sessions binary")

    def _held(self):
        return pickle.loads(self.open.get()[0]) if self.open.exists() else None

    def _timers(self, sessions):
        return (sessions["last"].to_numpy() + self.gap_us) // 1000 + 1

    def _merged(self, rows):
        """Rows and sessions of any order as sessions."""
        kind = rows["null"].to_numpy() + 2 * pd.factorize(rows["key"], use_na_sentinel=False)[0]
        order = np.lexsort((rows["start"], kind))
        rows, kind = rows.take(order), kind[order]
        start, last = rows["start"].to_numpy(), rows["last"].to_numpy()
        reached = pd.Series(last).groupby(kind).cummax().to_numpy()
        new = np.ones(len(rows), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (start[1:] - reached[:-1] > self.gap_us)
        first = np.flatnonzero(new)
        return rows.iloc[first].assign(
            last=np.maximum.reduceat(last, first), n=np.add.reduceat(rows["n"].to_numpy(), first)).reset_index(drop=True)

    def handleInputRows(self, key, rows, timerValues):
        held = self._held()
        before = None if held is None else int(self._timers(held).min())
        for pdf in rows:  # merged piece by piece: no more is held than a piece and the sessions
            pdf.columns = ["bucket", "key", "null", "ts"]  # Spark may name them anew
            pdf = pdf[pdf["ts"].notna()]
            if len(pdf):
                times = pdf["ts"].to_numpy("datetime64[us]").astype("int64")
                new = self._merged(pd.DataFrame({
                    "key": pdf["key"].to_numpy(), "null": pdf["null"].to_numpy(bool), "start": times, "last": times, "n": 1}))
                held = new if held is None else self._merged(pd.concat([held, new], ignore_index=True))
        if held is None:
            return
        self.open.update((pickle.dumps(held),))
        after = int(self._timers(held).min())
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self._held()
        if held is None:
            return
        over = self._timers(held) <= now
        done, rest = held[over], held[~over].reset_index(drop=True)
        if len(rest):
            self.open.update((pickle.dumps(rest),))
            self.handle.registerTimer(int(self._timers(rest).min()))
        else:
            self.open.clear()
        if len(done):
            yield pd.DataFrame({
                self.key: pd.Series([None if x else k for k, x in zip(done["key"], done["null"])], dtype=object),
                "session_start": pd.to_datetime(done["start"].to_numpy(), unit="us", utc=True),
                "last_event": pd.to_datetime(done["last"].to_numpy(), unit="us", utc=True),
                "n": done["n"].to_numpy()})

    def close(self) -> None:
        pass


def closed_sessions(df: DataFrame, key: str, gap_seconds: float, delay: str, ts: str = "ts", buckets: int = 512) -> DataFrame:
    """(key, session_start, last_event, n) in append mode: a session is emitted once, by an event-time
    timer, when the watermark has passed the last moment at which a row could continue it (a row
    exactly ``gap_seconds`` later still does). Rows behind the watermark and rows without a time are
    dropped. State is the open sessions, a few per key within ``delay``. Keys are dealt into ``buckets`` by their
    hash, which share a state and a timer: reading and setting these costs far more than a row. Keep
    ``buckets`` for the life of a checkpoint, and let a few thousand keys share one."""
    at = F.col(key)
    whole = df.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    timed = df.select(
        F.pmod(F.xxhash64(at), F.lit(buckets)).cast("int").alias("_bucket"),
        (F.coalesce(at, F.lit(0).cast(df.schema[key].dataType)) if whole else at).alias("_key"),  # pandas has no null there
        at.isNull().alias("_null"), F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, delay)
    kind = df.schema[key].dataType.simpleString()
    return timed.groupBy("_bucket").transformWithStateInPandas(
        _Sessions(key, round(gap_seconds * 1_000_000)),
        f"`{key}` {kind}, session_start timestamp, last_event timestamp, n long", "append", "eventTime")


def _current(spark: SparkSession, path: str, before: int | None = None):
    """Folder of the newest version of every bucket, of the versions under ``before``."""
    versions = spark.read.schema("bucket int, version long").parquet(f"{path}/versions/*")
    if before is not None:
        versions = versions.filter(F.col("version") < before)
    rows = versions.groupBy("bucket").agg(F.max("version").alias("version")).collect()  # one row per bucket
    return {r.bucket: f"{path}/data/version={r.version}/bucket={r.bucket}" for r in rows}


def upsert_latest(df: DataFrame, keys: list[str], order: list, path: str, checkpoint: str, buckets: int = 64):
    """Start keeping the last row per key (largest ``order``) of a stream in a table.

    The table is cut into ``buckets`` by the hash of the key. A micro-batch is reduced to its last row
    per key and merged with the buckets it touches, which are written anew under the number of the batch as
    version; the others stay as they are. A batch that is run again reads the versions before its own
    and replaces what it wrote, so it changes nothing. ``read_latest`` reads the newest version of each
    bucket. Old versions are not removed.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        last = [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order]
        new = top_n_per_key(batch, keys, last, 1).withColumn("_bucket", bucket).persist()
        try:
            touched = [r[0] for r in new.select("_bucket").distinct().collect()]  # at most ``buckets``
            spark.createDataFrame([], "bucket int, version long").write.mode("append").parquet(f"{path}/versions/none")
            current = _current(spark, path, batch_id)
            old = [current[b] for b in touched if b in current]
            rows = new
            if old:
                held = spark.read.schema(batch.schema).parquet(*old)
                rows = new.unionByName(held.withColumn("_bucket", bucket))
            (top_n_per_key(rows, keys, last, 1).withColumn("bucket", F.col("_bucket")).drop("_bucket")
             .repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/data/version={batch_id}"))
            spark.createDataFrame([(b, batch_id) for b in touched], "bucket int, version long").coalesce(1).write.mode(
                "overwrite").parquet(f"{path}/versions/{batch_id}")
        finally:
            new.unpersist()

    return (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )


def read_latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table kept by ``upsert_latest``."""
    found = list(_current(spark, path).values())
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def dedup_stream(df: DataFrame, keys: list[str], delay: str, ts: str = "ts") -> DataFrame:
    """First row per key within the watermark delay."""
    return (
        df.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    )


def append_stream(df: DataFrame, path: str, checkpoint: str, enrich=None):
    """Start appending micro-batches to a table. Each batch writes its own folder
    ``batch=<id>``, so a batch that is run again after a failure replaces itself."""

    def write(batch: DataFrame, batch_id: int):
        rows = batch if enrich is None else enrich(batch)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )


def write_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Run what is available into a parquet folder and wait. In ``complete`` mode each batch
    holds the whole result and replaces the one before."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", path).start()
    else:
        def write(batch: DataFrame, _):
            batch.write.mode("overwrite").parquet(path)

        query = writer.outputMode(mode).foreachBatch(write).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
