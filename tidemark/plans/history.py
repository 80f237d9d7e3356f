"""Versions of a table kept as a change log (events by user and day)."""

from pyspark.sql import functions as F

from ..operators import versions as v
from .registry import query

KEYS = ["user_id"]
MID, LATE = 12, 25

LOG = """log AS (
    SELECT user_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS _seq, max(CAST(ts AS TIMESTAMP)) AS _ts,
           CASE max_by(event_type, (ts, event_id)) WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op,
           max_by(event_type, (ts, event_id)) AS kind, max_by(value, (ts, event_id)) AS value
    FROM events GROUP BY 1, 2),
  snap AS (
    SELECT v, user_id, kind, value FROM (
      SELECT w.v, log.*, row_number() OVER (PARTITION BY w.v, user_id ORDER BY _seq DESC) AS rn
      FROM log JOIN (SELECT unnest(range(0, 30)) AS v) w ON _seq <= w.v) WHERE rn = 1 AND _op <> 'D')"""


def change_log(t):
    """One row per user and day: the day is the commit, ``error`` stands for a delete."""
    order = F.struct("ts", "event_id")
    kind = F.max_by("event_type", order)
    seq = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("_seq")
    return (
        t.events.groupBy("user_id", seq)
        .agg(F.max("ts").alias("_ts"), kind.alias("kind"), F.max_by("value", order).alias("value"))
        .withColumn("_op", F.when(F.col("kind") == "signup", "I").when(F.col("kind") == "error", "D").otherwise("U"))
    )


@query("as_of_version", f"WITH {LOG} SELECT user_id, kind, value FROM snap WHERE v = {MID}")
def as_of_version(t):
    return v.as_of(change_log(t), KEYS, version=MID)


@query("as_of_timestamp", f"""
    WITH {LOG} SELECT user_id, kind, value FROM snap
    WHERE v = (SELECT max(_seq) FROM log WHERE _ts <= TIMESTAMP '2024-01-18 23:59:59.999')""")
def as_of_timestamp(t):
    return v.as_of(change_log(t), KEYS, ts="2024-01-18 23:59:59.999")


@query("history", f"""
    WITH {LOG} SELECT _seq AS version, max(_ts) AS ts, CASE WHEN count(DISTINCT _op) > 1 THEN 'MERGE' WHEN min(_op) = 'I' THEN 'WRITE'
      WHEN min(_op) = 'U' THEN 'UPDATE' ELSE 'DELETE' END AS operation, count(*) FILTER (_op = 'I') AS n_inserted,
      count(*) FILTER (_op = 'U') AS n_updated, count(*) FILTER (_op = 'D') AS n_deleted FROM log GROUP BY 1""")
def history(t):
    return v.history(change_log(t))


@query("restore", f"WITH {LOG} SELECT user_id, kind, value FROM snap WHERE v = {MID}")
def restore(t):
    restored = v.restore(change_log(t), KEYS, MID, ts="2024-02-01 00:00:00")
    return v.newest_rows(restored, KEYS).filter("_op <> 'D'").drop(*v.META)


@query("recover_deleted", f"""
    WITH {LOG} SELECT user_id, kind, value FROM snap WHERE v = {MID}
      AND user_id NOT IN (SELECT user_id FROM snap WHERE v = 29)""")
def recover_deleted(t):
    return v.recover_deleted(change_log(t), KEYS, MID)


@query("change_feed", f"""
    WITH {LOG}, a AS (SELECT * FROM snap WHERE v = {MID}), b AS (SELECT * FROM snap WHERE v = {LATE})
    SELECT user_id, b.kind, b.value, 'insert' AS _change_type FROM b WHERE user_id NOT IN (SELECT user_id FROM a)
    UNION ALL SELECT user_id, kind, value, 'delete' FROM a WHERE user_id NOT IN (SELECT user_id FROM b)
    UNION ALL SELECT a.user_id, a.kind, a.value, 'update_preimage' FROM a JOIN b USING (user_id)
      WHERE (a.kind, a.value) IS DISTINCT FROM (b.kind, b.value)
    UNION ALL SELECT b.user_id, b.kind, b.value, 'update_postimage' FROM a JOIN b USING (user_id)
      WHERE (a.kind, a.value) IS DISTINCT FROM (b.kind, b.value)""")
def change_feed(t):
    return v.change_feed(change_log(t), KEYS, MID, LATE)


@query("change_feed_by_commit", f"""
    WITH {LOG}, p AS (SELECT *, lag(_op) OVER w AS po, lag(kind) OVER w AS pk, lag(value) OVER w AS pv FROM log
                      WINDOW w AS (PARTITION BY user_id ORDER BY _seq)),
      r AS (SELECT *, po IS NOT NULL AND po <> 'D' AS had FROM p WHERE _seq BETWEEN {MID} AND {LATE})
    SELECT user_id, kind, value, 'insert' AS _change_type, _seq AS _commit_version, _ts AS _commit_timestamp
      FROM r WHERE _op <> 'D' AND NOT had
    UNION ALL SELECT user_id, pk, pv, 'delete', _seq, _ts FROM r WHERE _op = 'D' AND had
    UNION ALL SELECT user_id, pk, pv, 'update_preimage', _seq, _ts FROM r WHERE _op <> 'D' AND had
    UNION ALL SELECT user_id, kind, value, 'update_postimage', _seq, _ts FROM r WHERE _op <> 'D' AND had""")
def change_feed_by_commit(t):
    return v.change_feed_by_commit(change_log(t), KEYS, MID, LATE)


@query("snapshot_copy", "SELECT o_orderkey, o_totalprice FROM orders")
def snapshot_copy(t):
    path = t.scratch("copy")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    v.snapshot_copy(rows.filter("o_totalprice < 100000"), None, ["o_orderkey"]).write.parquet(path)
    for _ in range(2):  # the second pass finds nothing new
        have = t.spark.read.parquet(path)
        v.snapshot_copy(rows, have, ["o_orderkey"]).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("expire_history", f"""
    WITH {LOG}, base AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _seq DESC) AS rn FROM log WHERE _seq <= {MID})
        WHERE rn = 1 AND _op <> 'D'),
      kept AS (SELECT user_id, _seq, _op FROM log WHERE _seq > {MID} UNION ALL SELECT user_id, _seq, _op FROM base)
    SELECT user_id, _seq, _op, 'kept' AS state FROM kept
    UNION ALL SELECT user_id, _seq, _op, 'dropped' FROM log WHERE (user_id, _seq) NOT IN (SELECT user_id, _seq FROM kept)""")
def expire_history(t):
    log = change_log(t)
    head = log.agg(F.max("_seq").alias("h")).first()["h"]
    kept, dropped = v.expire_history(log, KEYS, MID, head, min_keep=7)
    cols = ["user_id", "_seq", "_op"]
    return kept.select(*cols, F.lit("kept").alias("state")).unionAll(dropped.select(*cols, F.lit("dropped").alias("state")))
