"""Audit, usage and operations reports (events as the audit log)."""

from pyspark.sql import functions as F

from ..operators import audit
from .joins import PRICE_CTE, price_list, usage
from .registry import query

NOW = "2024-01-30 12:00:00"


def audit_log(t):
    """Events shaped like audit records: nested identity and response, a request map."""
    return t.events.select(
        "event_id", F.col("ts").alias("event_time"), F.col("event_type").alias("action_name"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("email")).alias("user_identity"),
        F.from_json("props", "MAP<STRING, STRING>").alias("request_params"),
        F.struct(F.when(F.col("event_type") == "error", 403).otherwise(200).alias("statusCode")).alias("response"),
        F.concat(F.lit("10.0.0."), (F.col("event_id") % 16).cast("string")).alias("source_ip_address"), "value",
    )


@query("failed_login_burst", f"""
    SELECT 'user' || user_id AS email, count(*) AS failures, max(ts) AS last_attempt,
           string_agg(DISTINCT '10.0.0.' || (event_id % 16), ',' ORDER BY '10.0.0.' || (event_id % 16)) AS sources
    FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '{NOW}' - INTERVAL 4320 MINUTES AND ts < TIMESTAMP '{NOW}'
    GROUP BY 1 HAVING count(*) >= 3""")
def failed_login_burst(t):
    log = audit_log(t).withColumn("email", F.col("user_identity.email"))
    found = audit.failure_bursts(
        log, "email", "event_time", "source_ip_address", "response.statusCode <> 200", NOW, minutes=4320, at_least=3
    )
    return found.withColumn("sources", F.array_join("sources", ","))


@query("sensitive_access", f"""
    SELECT ts AS event_time, 'user' || user_id AS actor, event_type AS action_name, json_extract_string(props, '$.k') AS securable
    FROM events WHERE event_type IN ('view', 'purchase') AND json_extract_string(props, '$.k') = '42'
      AND ts >= TIMESTAMP '{NOW}' - INTERVAL 20 DAYS AND ts < TIMESTAMP '{NOW}'""")
def sensitive_access(t):
    log = audit_log(t).withColumn("actor", F.col("user_identity.email")).withColumn("securable", F.col("request_params")["k"])
    return audit.sensitive_access(
        log, "event_time", NOW, 20, ["view", "purchase"], "k", "42", ["event_time", "actor", "action_name", "securable"]
    )


@query("change_audit", f"""
    SELECT ts AS event_time, 'user' || user_id AS actor, event_type AS action_name FROM events
    WHERE (event_type IN ('signup') OR event_type ILIKE '%URCH%') AND ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAYS
      AND ts < TIMESTAMP '{NOW}'""")
def change_audit(t):
    found = audit.change_audit(audit_log(t), "event_time", NOW, 7, ["signup"], ["%URCH%"])
    return found.select("event_time", F.col("user_identity.email").alias("actor"), "action_name").orderBy(
        F.desc("event_time"), "actor"
    )


@query("denied_events", """
    SELECT event_id, ts AS event_time, 403 AS status FROM events WHERE event_type = 'error'
    ORDER BY ts DESC, event_id DESC LIMIT 100""")
def denied_events(t):
    log = audit_log(t).select("event_id", "event_time", F.col("response.statusCode").alias("status"))
    return audit.denied(log, "event_time", "status", "event_id")


@query("network_denials", """
    SELECT ts AS event_time, 'user' || user_id AS source_user, '10.0.0.' || (event_id % 16) AS source_address,
           'host' || (event_id % 7) AS destination, 'rule_' || event_type AS rule_id FROM events WHERE value > 100""")
def network_denials(t):
    shaped = audit_log(t).select(
        "event_time",
        F.struct(F.col("user_identity.email").alias("user"), F.col("source_ip_address").alias("address")).alias("source"),
        F.struct(F.concat(F.lit("host"), (F.col("event_id") % 7).cast("string")).alias("name")).alias("destination"),
        F.struct(F.concat(F.lit("rule_"), "action_name").alias("id")).alias("rule"),
        F.when(F.col("value") > 100, "DENY").otherwise("ALLOW").alias("decision"),
    )
    return audit.network_denials(shaped)


@query("usage_by_sku", """
    SELECT l_shipdate AS usage_day, p_brand AS sku, round(sum(l_quantity), 2) AS units
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate >= TIMESTAMP '1999-06-30' - INTERVAL 30 DAYS AND l_shipdate < TIMESTAMP '1999-06-30' GROUP BY ALL""")
def usage_by_sku(t):
    used = usage(t).withColumnRenamed("used_at", "usage_day").withColumnRenamed("brand", "sku")
    return audit.usage_by_day(used, "usage_day", "sku", "l_quantity", "1999-06-30", 30)


@query("usage_cost", f"""
    WITH {PRICE_CTE}
    SELECT CAST(used_at AS DATE) AS day, u.brand, round(sum(l_quantity), 2) AS qty, round(sum(l_quantity * unit_price), 4) AS cost
    FROM usage u JOIN price p ON u.brand = p.brand
     AND used_at BETWEEN price_start AND coalesce(price_end, TIMESTAMP '2003-01-01') GROUP BY ALL""")
def usage_cost(t):
    used = usage(t).withColumn("day", F.to_date("used_at"))
    return audit.usage_cost(used, price_list(t), "day", "brand", "used_at", "l_quantity", "2003-01-01")


@query("lineage_lookup", """
    SELECT DISTINCT 'nation_' || c_nationkey AS source_table, c_mktsegment AS source_column, 'status_' || o_orderstatus AS target_table,
      o_orderpriority AS target_column FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'""")
def lineage_lookup(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    lineage = joined.select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("source_table"),
        F.col("c_mktsegment").alias("source_column"), F.concat(F.lit("status_"), "o_orderstatus").alias("target_table"),
        F.col("o_orderpriority").alias("target_column"),
    )
    return audit.upstream(lineage, "status_F", "5-LOW")


@query("maintenance_history", f"""
    SELECT event_type AS operation_type, CASE WHEN value > 60 THEN 'FAILED' ELSE 'SUCCESSFUL' END AS operation_status,
           count(*) AS n, round(sum(value), 4) AS usage, max(ts) AS last_run FROM events
    WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAYS AND ts < TIMESTAMP '{NOW}' GROUP BY ALL""")
def maintenance_history(t):
    runs = t.events.select(
        F.col("event_type").alias("operation_type"), F.when(F.col("value") > 60, "FAILED").otherwise("SUCCESSFUL").alias("operation_status"),
        F.col("value").alias("usage"), "ts",
    )
    return audit.maintenance_history(runs, "ts", NOW, 7)
