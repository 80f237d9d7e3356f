"""Structured Streaming queries driven by the events table."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators import ordered
from ..streaming import cdc as stream_cdc
from ..streaming import jobs
from .changes import FEED, feed_of, scd2_sql
from .history import KEYS
from .registry import query


def events_stream(t, path=None, max_files=None):
    return jobs.file_stream(
        t.spark, path or jobs.table_glob(t.path("events")), t.events.schema, event_time="ts", max_files=max_files
    )


def _ntz(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def windows_sql(minutes, by):
    keys = f", {by}" if by else ""
    return f"""
    WITH w AS (SELECT time_bucket(INTERVAL {minutes} MINUTES, ts, TIMESTAMP '2000-01-01') AS window_start{keys}, count(*) AS n
               FROM events GROUP BY ALL)
    SELECT window_start, window_start + INTERVAL {minutes} MINUTES AS window_end{keys}, n FROM w
    WHERE window_start + INTERVAL {minutes} MINUTES <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTES"""


def _windowed(t, name, minutes, by):
    out = t.scratch(name)
    stream = jobs.tumbling_counts(events_stream(t), "ts", f"{minutes} minutes", "10 minutes", by)
    jobs.finish(jobs.to_files(stream, out + "/data", out + "/state"))
    return _ntz(t.spark.read.parquet(out + "/data"), "window_start", "window_end")


@query("stream_tumbling_agg", windows_sql(5, "user_id"))
def stream_tumbling_agg(t):
    return _windowed(t, "tumbling", 5, ["user_id"])


@query("stream_minute_counts", windows_sql(1, ""))
def stream_minute_counts(t):
    return _windowed(t, "minutes", 1, [])


CUT = "2024-01-20"


@query("stream_late_data", f"""
    SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{CUT}' GROUP BY 1""")
def stream_late_data(t):
    """The older half arrives after the newer: it lies behind the watermark and is dropped."""
    path, out = t.scratch("late-in"), t.scratch("late")

    def work(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    # A file stream takes older files first, so each half is landed and run on its own.
    for where in (F.col("ts") >= CUT, F.col("ts") < CUT):
        t.events.filter(where).write.mode("append").parquet(path)
        stream = jobs.tumbling_counts(events_stream(t, path), "ts", "1 hour", "0 seconds")
        jobs.finish(jobs.for_each_batch(stream, work, out + "/state", "update"))
    updates = t.spark.read.parquet(out + "/data")
    newest = ordered.latest(updates, ["window_start"], [F.desc("batch")])
    return _ntz(newest.select("window_start", "n"), "window_start")


@query("stream_dedup", "SELECT DISTINCT event_id FROM events")
def stream_dedup(t):
    path, out = t.scratch("dup-in"), t.scratch("dup")
    for copy in range(2):
        t.events.withColumn("copy", F.lit(copy)).write.mode("append").parquet(path)
    stream = jobs.file_stream(t.spark, path, t.spark.read.parquet(path).schema, event_time="ts")
    once = jobs.deduplicated(stream, ["event_id"], "ts", "40 days").select("event_id")
    jobs.finish(jobs.to_files(once, out + "/data", out + "/state"))
    return t.spark.read.parquet(out + "/data")


@query("stream_output_modes", """
    WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT 'complete' AS mode, event_type, n FROM c UNION ALL SELECT 'update', event_type, n FROM c
    UNION ALL SELECT 'append refused', event_type, 0 FROM c""")
def stream_output_modes(t):
    """Complete rewrites the whole result, update sends changed rows, append refuses an unwindowed aggregate."""
    found = None
    for mode in ("complete", "update"):
        out = t.scratch(mode)

        def work(batch, batch_id, out=out):
            batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

        counts = events_stream(t).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        jobs.finish(jobs.for_each_batch(counts, work, out + "/state", mode))
        last = ordered.latest(t.spark.read.parquet(out + "/data"), ["event_type"], [F.desc("batch")])
        part = last.select(F.lit(mode).alias("mode"), "event_type", "n")
        found = part if found is None else found.unionAll(part)
    out = t.scratch("append")
    try:
        jobs.finish(jobs.for_each_batch(counts, lambda batch, batch_id: None, out, "append"))
        state = "append"
    except AnalysisException:
        state = "append refused"
    return found.unionAll(last.select(F.lit(state), "event_type", F.lit(0).cast("long")))


@query("stream_trigger", """
    SELECT 'once' AS trigger, event_id, user_id FROM events UNION ALL SELECT 'interval', event_id, user_id FROM events""")
def stream_trigger(t):
    """Everything available and then stop, twice; and every second, until files that land while it runs are through."""
    out = t.scratch("trigger")
    stream = events_stream(t).select("event_id", "user_id")
    for _ in range(2):  # the second run finds nothing and stops
        jobs.finish(jobs.to_files(stream, out + "/data", out + "/state"))
    once = t.spark.read.parquet(out + "/data").select(F.lit("once").alias("trigger"), "event_id", "user_id")

    path, half = t.scratch("interval-in"), F.col("event_id") % 2 == 0
    t.events.filter(half).write.parquet(path)
    running = jobs.to_files(events_stream(t, path).select("event_id", "user_id"), out + "/live", out + "/live-state", every="1 second")
    t.events.filter(~half).write.mode("append").parquet(path)
    jobs.run_until(running, lambda: running.lastProgress is not None and running.lastProgress.batchId >= 0)
    live = t.spark.read.parquet(out + "/live").select(F.lit("interval"), "event_id", "user_id")
    return once.unionAll(live)


NEWEST = """SELECT user_id, event_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query("stream_foreach_batch", NEWEST)
def stream_foreach_batch(t):
    out, keys, order = t.scratch("keyed"), ["user_id"], ["ts", "event_id"]
    sink = jobs.keyed_sink(out + "/data", keys, order)

    def work(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)  # a replayed batch changes nothing

    rows = events_stream(t, _in_parts(t, 3), max_files=1).select("user_id", "event_id", "event_type", "ts")
    jobs.finish(jobs.for_each_batch(rows, work, out + "/state"))
    return jobs.read_keyed(t.spark, out + "/data", keys).drop("ts")


@query("stream_append_flows", """
    SELECT 'errors' AS flow, event_id FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'others', event_id FROM events WHERE event_type <> 'error'""")
def stream_append_flows(t):
    out = t.scratch("flows")
    rows = events_stream(t).select("event_id", "event_type")
    flows = {
        "errors": rows.filter("event_type = 'error'").select("event_id"),
        "others": rows.filter("event_type <> 'error'").select("event_id"),
    }
    for running in jobs.append_flows(flows, out + "/data", out + "/state").values():
        jobs.finish(running)
    return jobs.read_flows(t.spark, out + "/data", list(flows)).select("flow", "event_id")


@query("stream_restart", "SELECT event_id, event_type FROM events")
def stream_restart(t):
    """The first run sees half of the files, the second resumes from the checkpoint."""
    path, out = t.scratch("restart-in"), t.scratch("restart")
    for where in (F.col("ts") < CUT, F.col("ts") >= CUT):
        t.events.filter(where).write.mode("append").parquet(path)
        stream = events_stream(t, path).select("event_id", "event_type")
        jobs.finish(jobs.to_files(stream, out + "/data", out + "/state"))
    return t.spark.read.parquet(out + "/data")


@query("stream_progress", """
    WITH e AS (SELECT event_id % 4 AS part, count(*) AS n FROM events GROUP BY 1)
    SELECT part AS batch_id, n AS input_rows, (SELECT sum(n) FROM e) - sum(n) OVER (ORDER BY part) AS lag_rows FROM e""")
def stream_progress(t):
    """Rows of every batch and what the source still holds after it; each batch is one landed file."""
    path, out = t.scratch("progress-in"), t.scratch("progress")
    for part in range(4):  # a file stream takes older files first
        t.events.filter(F.col("event_id") % 4 == part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    stream = events_stream(t, path, max_files=1).select("event_id")
    with jobs.ProgressLog(t.spark) as log:
        rows = log.progress_rows(jobs.finish(jobs.to_files(stream, out + "/data", out + "/state")))
    return jobs.with_lag(rows.filter("input_rows > 0"), t.events.count()).select("batch_id", "input_rows", "lag_rows")


@query("stream_rate_limit", "SELECT count(*) AS n, 3 AS batches FROM events")
def stream_rate_limit(t):
    path, out = t.scratch("rate-in"), t.scratch("rate")
    t.events.repartition(6).write.parquet(path)

    def work(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    jobs.finish(jobs.for_each_batch(events_stream(t, path, max_files=2), work, out + "/state"))
    return t.spark.read.parquet(out + "/data").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("batch").alias("batches"))


@query("join_stream_static", """
    SELECT event_id, user_id, coalesce(c_mktsegment, 'none') AS segment FROM events LEFT JOIN customer ON c_custkey = user_id""")
def join_stream_static(t):
    out = t.scratch("static")
    names = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    joined = jobs.with_static(events_stream(t), names, "user_id").select(
        "event_id", "user_id", F.coalesce("c_mktsegment", F.lit("none")).alias("segment")
    )
    jobs.finish(jobs.to_files(joined, out + "/data", out + "/state"))
    return t.spark.read.parquet(out + "/data")


@query("join_stream_stream", """
    SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p ON v.user_id = p.user_id
      AND v.event_type = 'view' AND p.event_type = 'purchase' AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR""")
def join_stream_stream(t):
    out = t.scratch("two-streams")
    view = events_stream(t).filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("v_ts")
    )
    buy = events_stream(t).filter("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("p_ts")
    )
    joined = jobs.joined_within(view, buy, ["user_id"], "v_ts", "p_ts", 3600, "2 hours").select("view_id", "purchase_id")
    jobs.finish(jobs.to_files(joined, out + "/data", out + "/state"))
    return t.spark.read.parquet(out + "/data")


def _in_parts(t, n):
    """The events in files of mixed times, so that every micro-batch of one file holds rows that come late."""
    path = t.scratch("parts")
    t.events.repartition(n, "event_id").write.parquet(path)
    return path


def _feed_stream(t, n):
    return feed_of(events_stream(t, _in_parts(t, n), max_files=1))


@query("cdc_stream", f"""
    WITH {FEED} SELECT user_id, tier, last_value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
    WHERE rn = 1 AND operation <> 'error'""")
def cdc_stream(t):
    out = t.scratch("cdc")
    jobs.finish(stream_cdc.keep_current(
        _feed_stream(t, 4), out + "/data", out + "/state", KEYS, "ts", buckets=8,
        deletes="operation = 'error'", except_cols=["operation", "event_id"], tie=["event_id"],
    ))
    return stream_cdc.read_current(t.spark, out + "/data", KEYS, 8)


@query("cdc_stream_history", scd2_sql("tier"))
def cdc_stream_history(t):
    out = t.scratch("cdc2")
    jobs.finish(stream_cdc.keep_history(
        _feed_stream(t, 3), out + "/data", out + "/state", KEYS, "ts", buckets=8,
        deletes="operation = 'error'", except_cols=["operation", "event_id", "last_value"], tie=["event_id"],
    ))
    return _ntz(stream_cdc.read_history(t.spark, out + "/data", KEYS, 8), "__START_AT", "__END_AT")
