"""Change-data-capture into current and historised dimensions (events as the feed)."""

from pyspark.sql import functions as F

from ..operators import cdc
from ..operators import versions as v
from .history import KEYS, LATE, LOG, MID, change_log
from .registry import query


def feed_of(events):
    """Feed of user states: ``error`` deletes, ``last_value`` is a noisy column."""
    return events.select(
        "user_id", "event_id", "ts", F.col("event_type").alias("operation"),
        F.when(F.col("value") > 50, "high").otherwise("low").alias("tier"), F.col("value").alias("last_value"),
    )


def feed(t):
    return feed_of(t.events)


FEED = """feed AS (SELECT user_id, event_id, ts, event_type AS operation,
    CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS tier, value AS last_value FROM events)"""


@query("cdc_scd1", f"""
    WITH {FEED} SELECT user_id, tier, last_value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
    WHERE rn = 1 AND operation <> 'error'""")
def cdc_scd1(t):
    return cdc.scd1(
        feed(t), KEYS, "ts", deletes="operation = 'error'", except_cols=["operation", "event_id"], tie=["event_id"]
    )


@query("cdc_scd1_late", f"""
    WITH {FEED} SELECT user_id, tier, last_value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
    WHERE rn = 1 AND operation <> 'error'""")
def cdc_scd1_late(t):
    """Two deliveries, the newer half first: late rows must not undo deletes."""
    options = {"deletes": "operation = 'error'", "except_cols": ["operation", "event_id"], "tie": ["event_id"]}
    rows = feed(t)
    newer, older = rows.filter("ts >= '2024-01-16'"), rows.filter("ts < '2024-01-16'")
    state = cdc.scd1_state(newer, KEYS, "ts", **options)
    return cdc.scd1(older, KEYS, "ts", state=state, **options)


@query("cdc_truncate", f"""
    WITH {FEED}, last AS (SELECT max(ts) AS cut FROM feed WHERE operation = 'signup' AND user_id = (SELECT min(user_id) FROM feed))
    SELECT user_id, tier, last_value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM feed, last WHERE ts > cut) WHERE rn = 1 AND operation <> 'error'""")
def cdc_truncate(t):
    first_user = t.events.agg(F.min("user_id").alias("u")).first()["u"]
    return cdc.scd1(
        feed(t), KEYS, "ts", deletes="operation = 'error'", except_cols=["operation", "event_id"], tie=["event_id"],
        truncates=f"operation = 'signup' AND user_id = {first_user}",
    )


def scd2_sql(tracked, untracked=""):
    """Runs by counting the rows at which a tracked value changes or a delete intervened."""
    last = f", arg_max({untracked}, ts) AS {untracked}" if untracked else ""
    return f"""
    WITH {FEED},
      p AS (SELECT *, lag({tracked}) OVER w AS pt, lag(operation) OVER w AS po, lead(ts) OVER w AS nts FROM feed
            WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      r AS (SELECT *, sum(CASE WHEN po IS NULL OR po = 'error' OR operation = 'error' OR pt IS DISTINCT FROM {tracked}
                     THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM p)
    SELECT user_id, {tracked}{last}, min(ts) AS __START_AT, arg_max_null(nts, ts) AS __END_AT
    FROM r WHERE operation <> 'error' GROUP BY user_id, {tracked}, run"""


@query("cdc_scd2", scd2_sql("tier"))
def cdc_scd2(t):
    return cdc.scd2(
        feed(t), KEYS, "ts", deletes="operation = 'error'", except_cols=["operation", "event_id", "last_value"], tie=["event_id"]
    )


@query("cdc_scd2_track_except", scd2_sql("tier", "last_value"))
def cdc_scd2_track_except(t):
    return cdc.scd2(
        feed(t), KEYS, "ts", deletes="operation = 'error'", track_except=["last_value"],
        except_cols=["operation", "event_id"], tie=["event_id"],
    )


@query("scd2_intervals", f"""
    WITH {FEED} SELECT user_id, ts AS __START_AT, last_value, lag(ts) OVER w AS prev_start, lead(ts) OVER w AS __END_AT
    FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def scd2_intervals(t):
    from ..operators.ordered import neighbours

    rows = feed(t).select("user_id", "ts", "event_id", "last_value")
    linked = neighbours(rows, KEYS, ["ts", "event_id"], ["ts"], share=0.005)
    return linked.select(
        "user_id", F.col("ts").alias("__START_AT"), "last_value", F.col("_prev.ts").alias("prev_start"),
        F.col("_next.ts").alias("__END_AT"),
    )


@query("scd2_refresh", scd2_sql("tier"))
def scd2_refresh(t):
    options = {"deletes": "operation = 'error'", "except_cols": ["operation", "event_id", "last_value"], "tie": ["event_id"]}
    rows = feed(t)
    first, second = rows.filter("ts < '2024-01-20'"), rows.filter("ts >= '2024-01-20'")
    dimension = cdc.scd2(first, KEYS, "ts", **options)
    return cdc.scd2_refresh(dimension, first, second, KEYS, "ts", **options)


@query("cdc_from_snapshots", f"""
    WITH {LOG}, a AS (SELECT * FROM snap WHERE v = {MID}), b AS (SELECT * FROM snap WHERE v = {LATE})
    SELECT user_id, b.kind, b.value, 'I' AS _op, {LATE} AS _seq FROM b WHERE user_id NOT IN (SELECT user_id FROM a)
    UNION ALL SELECT user_id, NULL, NULL, 'D', {LATE} FROM a WHERE user_id NOT IN (SELECT user_id FROM b)
    UNION ALL SELECT b.user_id, b.kind, b.value, 'U', {LATE} FROM a JOIN b USING (user_id)
      WHERE (a.kind, a.value) IS DISTINCT FROM (b.kind, b.value)""")
def cdc_from_snapshots(t):
    log = change_log(t)
    return cdc.from_snapshots(v.as_of(log, KEYS, MID), v.as_of(log, KEYS, LATE), KEYS, LATE)


@query("cdc_apply_snapshot_changes", f"WITH {LOG} SELECT user_id, kind, value FROM snap WHERE v = {LATE}")
def cdc_apply_snapshot_changes(t):
    log = change_log(t)
    old, new = v.as_of(log, KEYS, MID), v.as_of(log, KEYS, LATE)
    return cdc.apply_changes(old, cdc.from_snapshots(old, new, KEYS, LATE), KEYS)


@query("scd2_manual_merge", """
    WITH u AS (SELECT c_custkey + 200 AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'MOVED' END AS segment,
                      DATE '2024-06-01' AS effective FROM customer),
         d AS (SELECT c_custkey AS id, c_mktsegment AS segment, DATE '2020-01-01' AS start_date,
                      CAST(NULL AS DATE) AS end_date, true AS is_current FROM customer)
    SELECT d.id, d.segment, d.start_date, CASE WHEN u.segment <> d.segment THEN u.effective END AS end_date,
           NOT coalesce(u.segment <> d.segment, false) AS is_current FROM d LEFT JOIN u ON d.id = u.id
    UNION ALL SELECT u.id, u.segment, u.effective, NULL, true FROM u LEFT JOIN d ON d.id = u.id
    WHERE d.id IS NULL OR d.segment <> u.segment""")
def scd2_manual_merge(t):
    c = t.customer
    dimension = c.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.lit("2020-01-01").cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    updates = c.select(
        (F.col("c_custkey") + 200).alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("MOVED").alias("segment"),
        F.lit("2024-06-01").cast("date").alias("effective"),
    )
    return cdc.scd2_merge(dimension, updates, ["id"], ["segment"], "effective")
