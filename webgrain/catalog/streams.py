"""Streaming queries over the event table, run to the end of what is there."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.plans.scale import fresh_path
from webgrain.session import SETTINGS
from webgrain.streaming import events as X


BATCHES = 4


def source(spark, sf):
    return X.read_stream(spark, sf, "events.parquet")


def feed(spark, sf, *columns):
    """The events as a stream of several micro-batches in the order of time."""
    events = table(spark, sf, "events").select(*columns)
    return X.read_stream(spark, X.replay(events, "ts", BATCHES, fresh_path(spark, "feed")), "*.parquet", files=1)


STORE = "spark.sql.streaming.stateStore.providerClass"


def run(df, label, mode="append"):
    """Run to the end; sessions made elsewhere may lack the state store that timers need."""
    spark = df.sparkSession
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, SETTINGS[STORE])
    try:
        return X.write_table(df, fresh_path(spark, label), fresh_path(spark, f"{label}-log"), mode)
    finally:
        spark.conf.set(STORE, before)


@query("""
with g as (select user_id, ts, coalesce(ts - lag(ts) over w > interval 6 hour, true) as first from events
  window w as (partition by user_id order by ts)),
s as (select *, sum(first::int) over (partition by user_id order by ts rows unbounded preceding) as s from g)
select user_id, min(ts) as session_start, max(ts) as last_event, count(*) as n from s group by user_id, s
having max(ts) + interval 6 hour < (select max(ts) from events) - interval 1 hour
""")
def stream_sessions(spark, sf):
    """Sessions that the watermark has closed, each emitted once by its timer."""
    out = run(X.closed_sessions(feed(spark, sf, "user_id", "ts"), "user_id", 6 * 3600, "1 hour"), "sessions")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "last_event")})


@query("""
select event_type, time_bucket(interval 1 hour, ts) as window_start, count(*) as n, count(*) > 4 as over
from events group by 1, 2 having time_bucket(interval 1 hour, ts) + interval 1 hour <= (select max(ts) from events) - interval 1 hour
""")
def stream_rate(spark, sf):
    """Windows that the watermark has closed."""
    out = run(X.rate_flags(feed(spark, sf, "event_type", "ts"), "event_type", 4, 3600, delay="1 hour"), "rate")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
select user_id, event_id, ts, event_type from events
qualify row_number() over (partition by user_id order by ts, event_id) <= 10
""")
def stream_cap(spark, sf):
    return run(X.cap_stream(feed(spark, sf, "user_id", "event_id", "ts", "event_type"), "user_id", ["ts", "event_id"]), "cap")


@query("""
select user_id, event_type, event_id, ts, value from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
""")
def stream_latest(spark, sf):
    events = feed(spark, sf, "user_id", "event_type", "event_id", "ts", "value")
    path = fresh_path(spark, "latest")
    X.upsert_latest(events, ["user_id", "event_type"], ["ts", "event_id"], path, fresh_path(spark, "latest-log"),
                    buckets=16).awaitTermination()
    return X.read_latest(spark, path, events.schema)


@query("select distinct user_id, event_type from events")
def stream_dedup(spark, sf):
    events = source(spark, sf).select("user_id", "event_type", "ts")
    return run(X.dedup_stream(events, ["user_id", "event_type"], "60 days"), "dedup").select(
        "user_id", "event_type")


@query("select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")
def stream_append(spark, sf):
    path = fresh_path(spark, "appended")

    def enrich(batch):
        return batch.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))

    X.append_stream(source(spark, sf), path, fresh_path(spark, "append-log"), enrich).awaitTermination()
    return spark.read.parquet(path).select("event_id", "k")
