import datetime as dt
import random

from pyspark.sql import functions as F

from webgrain.plans.scale import fresh_path
from webgrain.streaming import events as X

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "user_id int, event_id int, ts timestamp_ntz, kind string"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Feed:
    """A folder that gets one file per batch, and queries that run what is there."""

    def __init__(self, spark):
        self.spark, self.folder = spark, fresh_path(spark, "feed")
        self.out, self.log = fresh_path(spark, "out"), fresh_path(spark, "log")

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def run(self, transform, mode="append"):
        source = X.read_stream(self.spark, self.folder, "*.parquet")
        return X.write_table(transform(source), self.out, self.log, mode)


def test_sessions_equal_batch(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 3), i, at(rnd.randint(0, 500)), "a") for i in range(200)]
    feed = Feed(spark)
    feed.add(rows[:100])
    feed.add(rows[100:])
    stream = feed.run(lambda df: X.sessions(df, "user_id", "6 seconds"), "complete")
    batch = X.sessions(spark.createDataFrame(rows, SCHEMA), "user_id", "6 seconds")
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    want = 0
    for user in range(4):
        times = sorted(r[2] for r in rows if r[0] == user)
        want += 1 + sum((b - a).total_seconds() > 6 for a, b in zip(times, times[1:]))
    assert batch.count() == want


def test_a_pause_of_exactly_the_gap_stays_in_the_session(spark):
    df = spark.createDataFrame([(1, 1, at(0), "a"), (1, 2, at(6), "a"), (1, 3, at(12.001), "a")], SCHEMA)
    rows = X.sessions(df, "user_id", "6 seconds").orderBy("session_start").collect()
    assert [r["n"] for r in rows] == [2, 1]


def test_late_rows_are_dropped(spark):
    feed = Feed(spark)

    def transform(df):
        return X.rate_flags(df, "kind", 1, 10, delay="5 seconds")

    feed.add([(1, 1, at(1), "a"), (1, 2, at(2), "a"), (1, 3, at(100), "a")])
    first = feed.run(transform).collect()
    assert [(r["n"], r["over"]) for r in first] == [(2, True)]
    feed.add([(1, 4, at(3), "a"), (1, 5, at(101), "a"), (1, 6, at(300), "a")])
    second = {r["window_start"]: r["n"] for r in feed.run(transform).collect()}
    assert second == {at(0): 2, at(100): 2}  # the row at 3 s came too late


def test_timers_close_sessions_over_batches(spark):
    """Four micro-batches: out of order within the delay, a row that joins two sessions, a late row."""
    feed = Feed(spark)

    def run():
        out = feed.run(lambda df: X.closed_sessions(df, "user_id", 6, "10 seconds"))
        return sorted((r.user_id, (r.session_start - T0).total_seconds(), (r.last_event - T0).total_seconds(), r.n)
                      for r in out.collect())

    feed.add([(1, 1, at(0), "a"), (1, 2, at(6), "a"), (1, 3, at(14), "a"), (2, 4, at(3), "a"), (3, 5, None, "a")])
    assert run() == []
    feed.add([(1, 6, at(10), "a"), (2, 7, at(20), "a")])  # 10 s joins both sessions of key 1
    assert run() == [(2, 3.0, 3.0, 1)]
    feed.add([(1, 8, at(100), "a"), (1, 9, at(12), "a")])
    assert run() == [(1, 0.0, 14.0, 5), (2, 3.0, 3.0, 1), (2, 20.0, 20.0, 1)]
    feed.add([(1, 10, at(15), "a"), (1, 11, at(106), "a"), (2, 12, at(200), "a")])  # 15 s is behind the watermark
    assert run() == [(1, 0.0, 14.0, 5), (1, 100.0, 106.0, 2), (2, 3.0, 3.0, 1), (2, 20.0, 20.0, 1)]


def test_closed_sessions_equal_those_of_a_batch(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 3), i, at(i + rnd.random() * 5), "a") for i in range(0, 400, 2)] + [(9, 999, at(10 ** 6), "a")]
    path = X.replay(spark.createDataFrame(rows, SCHEMA), "ts", 5, fresh_path(spark, "feed"))
    stream = X.read_stream(spark, path, "*.parquet", files=1)
    out = X.write_table(X.closed_sessions(stream, "user_id", 6, "8 seconds"), fresh_path(spark, "out"), fresh_path(spark, "log"))
    batch = X.sessions(spark.createDataFrame(rows[:-1], SCHEMA), "user_id", "6 seconds")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_keys_share_a_state_and_stay_apart(spark):
    """Null keys, large numbers and text, all in one bucket, over three micro-batches."""
    big = 2 ** 60
    for kind, keys in (("long", [None, 0, big, big + 1]), ("string", [None, "", "a"])):
        rows = [(k, at(10 * step + i)) for step in (0, 1, 5) for k in keys for i in range(3)]
        path = X.replay(spark.createDataFrame(
            rows + [(keys[1], at(10 ** 6))], f"k {kind}, ts timestamp_ntz"), "ts", 3, fresh_path(spark, "feed"))
        stream = X.read_stream(spark, path, "*.parquet", files=1)
        out = X.write_table(X.closed_sessions(stream, "k", 20, "8 seconds", buckets=1), fresh_path(spark, "out"), fresh_path(spark, "log"))
        got = sorted(((r.k, r.session_start, r.last_event, r.n) for r in out.collect()), key=str)
        assert got == sorted([(k, at(a), at(b), n) for k in keys for a, b, n in ((0, 12, 6), (50, 52, 3))], key=str)


def test_cap_forgets_idle_keys(spark):
    feed = Feed(spark)

    def run():
        out = feed.run(lambda df: X.cap_stream(df, "user_id", ["event_id"], n=2, ts="ts", idle_seconds=60))
        return sorted(r["event_id"] for r in out.collect())

    feed.add([(1, i, at(i), "a") for i in range(5)] + [(2, 50, at(0), "a"), (2, 51, at(1), "a")])
    assert run() == [0, 1, 50, 51]
    feed.add([(1, i, at(i + 50), "a") for i in range(5, 9)])  # still counted, and so is key 2 by now
    assert run() == [0, 1, 50, 51]
    feed.add([(1, 20, at(100), "a"), (2, 52, at(100), "a")])  # key 1 was seen at 58 s, key 2 at 1 s
    assert run() == [0, 1, 50, 51]
    feed.add([(2, 53, at(101), "a"), (3, 60, at(500), "a")])
    assert run() == [0, 1, 50, 51, 60]
    feed.add([(1, 21, at(501), "a"), (2, 54, at(501), "a")])
    assert run() == [0, 1, 21, 50, 51, 54, 60]


def test_latest_rows_over_batches_and_a_replayed_batch(spark):
    rnd = random.Random(6)
    feed, state = Feed(spark), {}

    def upsert(log):
        source = X.read_stream(spark, feed.folder, "*.parquet")
        X.upsert_latest(source, ["user_id"], ["ts", "event_id"], feed.out, log, buckets=5).awaitTermination()
        return {r.user_id: (r.ts, r.event_id) for r in X.read_latest(spark, feed.out, source.schema).collect()}

    rows = []
    for step in range(4):
        new = [(rnd.choice([None, *range(12)]), 100 * step + i, rnd.choice([None, at(rnd.randint(0, 50))]), "a") for i in range(9)]
        rows += new
        feed.add(new)
        for u, e, t, _ in new:
            state[u] = max(state.get(u, (t, e)), (t, e), key=lambda x: (x[0] is not None, x[0] or T0, x[1]))
        assert upsert(feed.log) == state
    before = sorted(r[0] for r in spark.read.parquet(f"{feed.out}/versions/*").select("version").distinct().collect())
    assert before == [0, 1, 2, 3]
    # a new log runs all rows again as batch 0: only what batch 0 wrote is replaced
    upsert(fresh_path(spark, "log"))
    assert {r.user_id: (r.ts, r.event_id) for r in X.read_latest(spark, feed.out, spark.createDataFrame([], SCHEMA).schema).collect()} == state


def test_latest_leaves_untouched_buckets_alone(spark):
    feed = Feed(spark)

    def upsert():
        source = X.read_stream(spark, feed.folder, "*.parquet")
        X.upsert_latest(source, ["user_id"], ["ts"], feed.out, feed.log, buckets=50).awaitTermination()

    feed.add([(i, i, at(i), "a") for i in range(40)])
    upsert()
    feed.add([(7, 100, at(100), "b")])
    upsert()
    assert spark.read.parquet(f"{feed.out}/versions/1").count() == 1
    assert spark.read.parquet(f"{feed.out}/data/version=1").count() < 10
    got = {r.user_id: r.event_id for r in X.read_latest(spark, feed.out, spark.createDataFrame([], SCHEMA).schema).collect()}
    assert got == {**{i: i for i in range(40)}, 7: 100}


def test_cap_over_batches(spark):
    feed = Feed(spark)
    hot = [(1, i, at(i), "a") for i in range(500)]
    feed.add(hot[:7] + [(2, 900, at(1), "a")])

    def transform(df):
        return X.cap_stream(df.select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"])

    feed.run(transform)
    feed.add(hot[7:] + [(2, 901, at(2), "a")])
    rows = feed.run(transform).collect()
    assert sorted(r["event_id"] for r in rows if r["user_id"] == 1) == list(range(10))
    assert sorted(r["event_id"] for r in rows if r["user_id"] == 2) == [900, 901]


def test_dedup_keeps_one_row_over_batches(spark):
    feed = Feed(spark)

    def transform(df):
        return X.dedup_stream(df, ["user_id"], "1 hour")

    feed.add([(1, 1, at(0), "a"), (1, 2, at(1), "a"), (2, 3, at(2), "a")])
    feed.run(transform)
    feed.add([(1, 4, at(3), "a"), (3, 5, at(4), "a")])
    assert sorted(r["user_id"] for r in feed.run(transform).collect()) == [1, 2, 3]


def test_append_adds_only_new_rows_and_replaces_a_repeated_batch(spark):
    feed = Feed(spark)

    def append():
        source = X.read_stream(spark, feed.folder, "*.parquet")
        X.append_stream(source, feed.out, feed.log,
                        lambda b: b.select("event_id", F.upper("kind").alias("k"))).awaitTermination()
        return spark.read.parquet(feed.out)

    feed.add([(1, 1, at(0), "a")])
    append()
    append()
    feed.add([(1, 2, at(0), "b")])
    rows = append().collect()
    assert sorted((r["event_id"], r["k"], r["batch"]) for r in rows) == [(1, "A", 0), (2, "B", 1)]
