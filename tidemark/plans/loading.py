"""Incremental ingest and idempotent batch loads of files landed from the tables."""

from pyspark.sql import functions as F

from ..operators.quality import ConstraintViolation, SchemaMismatch
from ..sources import copy_into as ci
from ..sources import ingest as ing
from .registry import query


def land(df, path, name, parts=2, fmt="json"):
    df.repartition(parts).write.format(fmt).save(f"{path}/{name}")


def _dirs(t, name):
    root = t.scratch(name)
    return f"{root}/in", f"{root}/state", f"{root}/table"


@query("ingest_stream", """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, 0 AS repeated FROM orders GROUP BY 1""")
def ingest_stream(t):
    source, state, table = _dirs(t, "ingest")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status in ("F", "O", "P"):
        land(rows.filter(F.col("o_orderstatus") == status), source, status)
        ing.ingest(t.spark, source, state, table)
    again = ing.ingest(t.spark, source, state, table)
    df = ing.read_ingested(t.spark, state, table)
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    ).withColumn("repeated", F.lit(again.rows))


@query("infer_schema_store", """
    SELECT 0 AS version, v.name, v.type, n FROM (VALUES ('event_id', 'bigint'), ('event_type', 'string'), ('value', 'double')) v(name, type),
      (SELECT count(*) AS n FROM events)""")
def infer_schema_store(t):
    source, state, table = _dirs(t, "infer")
    land(t.events.select("event_id", "event_type", "value"), source, "all")
    loaded = ing.ingest(t.spark, source, state, table)
    rows = [
        (v, f.name, f.dataType.simpleString(), loaded.rows)
        for v, s in enumerate(ing.stored_schemas(t.spark, state)) for f in s.fields
    ]
    return t.spark.createDataFrame(rows, "version int, name string, type string, n long")


def _two_halves(t, name, mode, first, second, hints=None, retry=True, fmt="json"):
    """Load the first half of the events, then the second with other columns; returns (table, failures)."""
    source, state, table = _dirs(t, name)
    land(t.events.filter("ts < '2024-01-16'").select(*first), source, "a", fmt=fmt)
    ing.ingest(t.spark, source, state, table, fmt, mode=mode, hints=hints)
    land(t.events.filter("ts >= '2024-01-16'").select(*second), source, "b", fmt=fmt)
    failures = 0
    for _ in range(2 if retry else 1):
        try:
            ing.ingest(t.spark, source, state, table, fmt, mode=mode, hints=hints)
            break
        except ing.UnknownFieldError:
            failures += 1
    return ing.read_ingested(t.spark, state, table, mode), failures


LATER = "ts >= TIMESTAMP '2024-01-16'"


@query("evolve_addNewColumns", f"""
    SELECT event_id, CASE WHEN {LATER} THEN event_type END AS event_type, 1 AS failures FROM events""")
def evolve_add(t):
    df, failures = _two_halves(t, "add", "addNewColumns", ["event_id"], ["event_id", "event_type"])
    return df.select("event_id", "event_type").withColumn("failures", F.lit(failures))


@query("evolve_typeWidening", f"""
    SELECT event_id, CASE WHEN {LATER} THEN user_id + 9007199254740993 ELSE user_id END AS amount FROM events""")
def evolve_widening(t):
    narrow = F.col("user_id").cast("int").alias("amount")
    wide = (F.col("user_id") + F.lit(9007199254740993)).alias("amount")
    df, _ = _two_halves(
        t, "widen", "addNewColumnsWithTypeWidening", ["event_id", narrow], ["event_id", wide], fmt="parquet"
    )
    return df.select("event_id", "amount")


@query("evolve_rescue", f"""
    SELECT event_id, CASE WHEN {LATER} THEN event_type END AS rescued_type, CASE WHEN {LATER} THEN value END AS rescued_value,
           0 AS failures FROM events""")
def evolve_rescue(t):
    df, failures = _two_halves(t, "rescue", "rescue", ["event_id"], ["event_id", "event_type", "value"])
    out = ing.rescued_fields(df, "event_type STRING, value DOUBLE")
    return out.select(
        "event_id", F.col("event_type").alias("rescued_type"), F.col("value").alias("rescued_value"), F.lit(failures).alias("failures")
    )


@query("evolve_failOnNew", f"SELECT event_id, 2 AS failures FROM events WHERE NOT ({LATER})")
def evolve_fail(t):
    df, failures = _two_halves(t, "fail", "failOnNewColumns", ["event_id"], ["event_id", "event_type"])
    return df.select("event_id", F.lit(failures).alias("failures"))


@query("evolve_none", "SELECT event_id, 1 AS n_columns FROM events")
def evolve_none(t):
    df, _ = _two_halves(t, "none", "none", ["event_id"], ["event_id", "event_type"])
    return df.withColumn("n_columns", F.lit(len(df.columns)))


@query("schema_hints", """
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS id, event_type,
           CASE WHEN event_type = 'error' THEN 'X' || event_id END AS rescued_id FROM events""")
def schema_hints(t):
    source, state, table = _dirs(t, "hints")
    text = F.col("event_id").cast("string")
    mixed = F.when(F.col("event_type") == "error", F.concat(F.lit('"X'), text, F.lit('"'))).otherwise(text)
    lines = t.events.select(F.concat(F.lit('{"id":'), mixed, F.lit(',"event_type":"'), "event_type", F.lit('"}')).alias("value"))
    lines.write.text(source + "/a")
    ing.ingest(t.spark, source, state, table, mode="rescue", hints="id INT")
    df = ing.read_ingested(t.spark, state, table, "rescue")
    rescued = F.get_json_object(ing.RESCUED, "$.id")
    return df.select("id", "event_type", rescued.alias("rescued_id"))


@query("rescued_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def rescued_extract(t):
    df = t.events.select("event_id", F.col("props").alias(ing.RESCUED))
    return ing.rescued_fields(df, "k INT").select("event_id", "k")


def _landed_orders(t, name, where="true"):
    source, state, table = _dirs(t, name)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rows.filter(where).repartition(2).write.parquet(source + "/f")
    return source, state, table, rows


@query("copy_into", """
    SELECT o_orderstatus, count(*) AS n, 0 AS repeated FROM orders GROUP BY 1""")
def copy_into(t):
    source, state, table, rows = _landed_orders(t, "copy", "o_orderstatus <> 'O'")
    ci.copy_into(t.spark, source, table, state)
    rows.filter("o_orderstatus = 'O'").repartition(2).write.parquet(source + "/o")
    ci.copy_into(t.spark, source, table, state)
    again = ci.copy_into(t.spark, source, table, state)
    loaded = ci.read_loaded(t.spark, table)
    return loaded.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("repeated", F.lit(again))


@query("copy_into_force", "SELECT 2 * count(*) AS n FROM orders")
def copy_into_force(t):
    source, state, table, _ = _landed_orders(t, "force")
    ci.copy_into(t.spark, source, table, state)
    ci.copy_into(t.spark, source, table, state, force=True)
    return ci.read_loaded(t.spark, table).agg(F.count(F.lit(1)).alias("n"))


@query("copy_into_transform", """
    SELECT CAST(o_orderkey AS INT) AS id, round(o_totalprice * 0.5, 4) AS half, upper(o_orderstatus) AS status
    FROM orders""")
def copy_into_transform(t):
    source, state, table, _ = _landed_orders(t, "transform")
    wanted = ["CAST(o_orderkey AS INT) AS id", "round(o_totalprice * 0.5, 4) AS half", "upper(o_orderstatus) AS status"]
    ci.copy_into(t.spark, source, table, state, select=wanted)
    return ci.read_loaded(t.spark, table)


@query("copy_into_pattern_files", """
    SELECT o_orderstatus, count(*) AS n, true AS exclusive FROM orders GROUP BY 1""")
def copy_into_pattern_files(t):
    source, state, table, rows = _landed_orders(t, "pattern")
    rows.filter("o_orderstatus = 'O'").write.json(source + "/json")
    ci.copy_into(t.spark, source, table, state, pattern="*.parquet")
    try:
        ci.copy_into(t.spark, source, table, state, pattern="*.parquet", files=["a"])
        exclusive = False
    except ValueError:
        exclusive = True
    return ci.read_loaded(t.spark, table).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(exclusive).alias("exclusive")
    )


@query("copy_into_merge_schema", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS channel, true AS refused
    FROM orders""")
def copy_into_merge_schema(t):
    source, state, table, _ = _landed_orders(t, "merge", "o_orderstatus <> 'O'")
    ci.copy_into(t.spark, source, table, state)
    wide = t.orders.filter("o_orderstatus = 'O'").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.col("o_orderpriority").alias("channel")
    )
    wide.write.parquet(source + "/o")
    try:
        ci.copy_into(t.spark, source, table, state)
        refused = False
    except SchemaMismatch:
        refused = True
    ci.copy_into(t.spark, source, table, state, merge_schema=True)
    return ci.read_loaded(t.spark, table).select("o_orderkey", "channel", F.lit(refused).alias("refused"))


@query("copy_into_validate", """
    SELECT o_orderstatus, count(*) AS n, 15 AS checked, (SELECT count(*) FROM orders) AS checked_all, true AS refused, true AS untouched FROM orders GROUP BY 1""")
def copy_into_validate(t):
    source, state, table, rows = _landed_orders(t, "validate")
    checked = ci.validate(t.spark, source, rows=15, not_null=["o_orderkey"], checks={"amount": "o_totalprice >= 0"}).count()
    everything = ci.validate(t.spark, source, rows=None, not_null=["o_orderkey"], checks={"amount": "o_totalprice >= 0"}).count()
    try:
        ci.validate(t.spark, source, rows=None, checks={"open": "o_orderstatus = 'O'"})
        refused = False
    except ConstraintViolation:
        refused = True
    untouched = ci.read_loaded(t.spark, table) is None
    ci.copy_into(t.spark, source, table, state)
    return ci.read_loaded(t.spark, table).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(checked).alias("checked"), F.lit(everything).cast("long").alias("checked_all"), F.lit(refused).alias("refused"), F.lit(untouched).alias("untouched")
    )
