"""Expectations, constraints, layers and alerts."""

from pyspark.sql import functions as F

from ..operators import medallion as layers
from ..operators import quality as q
from .registry import query

RULES = {
    "valid_id": "o_orderkey IS NOT NULL",
    "amount_in_range": "amount BETWEEN 1000 AND 300000",
    "known_status": "status IN ('O', 'F')",
}

SHAPED = """o AS (SELECT o_orderkey, o_custkey, o_totalprice AS amount, nullif(o_orderstatus, 'P') AS status, o_orderdate FROM orders)"""
OK = "coalesce(o_orderkey IS NOT NULL, false) AND coalesce(amount BETWEEN 1000 AND 300000, false) AND coalesce(status IN ('O', 'F'), false)"


def shaped(t):
    return t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderdate",
    )


METRICS = f"""
    WITH {SHAPED}, c AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey IS NOT NULL) AS a,
        count(*) FILTER (amount BETWEEN 1000 AND 300000) AS b, count(*) FILTER (status IN ('O', 'F')) AS c FROM o)
    SELECT 'valid_id' AS rule, a AS passed, n - a AS failed FROM c
    UNION ALL SELECT 'amount_in_range', b, n - b FROM c UNION ALL SELECT 'known_status', c, n - c FROM c"""


@query("expect_warn", METRICS)
def expect_warn(t):
    return q.expect(shaped(t), RULES, q.WARN)[2]


@query("expect_warn_observed", METRICS.replace("passed, n", "n_rows, n").replace("a AS n_rows", "n AS n_rows")
       .replace("'amount_in_range', b", "'amount_in_range', n").replace("'known_status', c", "'known_status', n"))
def expect_warn_observed(t):
    watched, seen = q.observed(shaped(t), RULES)
    watched.write.parquet(t.scratch("observed"))
    counts = seen.get
    rows = [(r, counts["n_rows"], counts[r]) for r in RULES]
    return t.spark.createDataFrame(rows, "rule string, n_rows long, failed long")


@query("expect_drop", f"WITH {SHAPED} SELECT o_orderkey, amount, status FROM o WHERE status IN ('O', 'F')")
def expect_drop(t):
    rules = {"known_status": RULES["known_status"]}
    return q.expect(shaped(t), rules, q.DROP)[0].select("o_orderkey", "amount", "status")


@query("expect_fail", f"SELECT *, true AS refused FROM ({METRICS}) WHERE failed > 0")
def expect_fail(t):
    """The rules that stop the load, with the rows that break them."""
    named = []
    try:
        q.expect(shaped(t), RULES, q.FAIL)
    except q.ExpectationFailed as error:
        named = error.args[1]
    broken = q.metrics(shaped(t), RULES).filter("failed > 0")
    return broken.withColumn("refused", F.col("rule").isin(named))


@query("expect_all", f"WITH {SHAPED} SELECT o_orderkey, ({OK}) AS ok FROM o")
def expect_all(t):
    good, bad, _ = q.expect(shaped(t), RULES, q.DROP)
    return good.select("o_orderkey", F.lit(True).alias("ok")).unionAll(bad.select("o_orderkey", F.lit(False).alias("ok")))


@query("quarantine", f"""
    WITH {SHAPED} SELECT o_orderkey, CASE WHEN {OK} THEN '' ELSE concat_ws(',',
        CASE WHEN NOT coalesce(amount BETWEEN 1000 AND 300000, false) THEN 'amount_in_range' END,
        CASE WHEN NOT coalesce(status IN ('O', 'F'), false) THEN 'known_status' END) END AS broken FROM o""")
def quarantine(t):
    valid, invalid = q.quarantine(shaped(t), RULES)
    return valid.select("o_orderkey", F.lit("").alias("broken")).unionAll(
        invalid.select("o_orderkey", F.array_join("_broken", ","))
    )


@query("quality_trend", """
    WITH r AS (SELECT CAST(ts AS DATE) AS run, 'no_error' AS rule, count(*) FILTER (event_type = 'error') AS failed
               FROM events GROUP BY 1
               UNION ALL SELECT CAST(ts AS DATE), 'small_value', count(*) FILTER (value > 150) FROM events GROUP BY 1),
         p AS (SELECT *, lag(failed) OVER (PARTITION BY rule ORDER BY run) AS previous FROM r)
    SELECT *, coalesce(failed > 1.2 * previous, false) AS spike FROM p""")
def quality_trend(t):
    per_day = t.events.groupBy(F.to_date("ts").alias("run")).agg(
        F.count_if(F.col("event_type") == "error").alias("no_error"), F.count_if(F.col("value") > 150).alias("small_value")
    )
    return q.quality_trend(per_day.unpivot("run", ["no_error", "small_value"], "rule", "failed"), factor=1.2)


@query("table_constraints", f"""
    WITH {SHAPED} SELECT 'status NOT NULL' AS "constraint", count(*) FILTER (status IS NULL) AS violations FROM o
    UNION ALL SELECT 'open_or_big', count(*) FILTER (NOT coalesce(status = 'O' OR amount > 2000, true)) FROM o""")
def table_constraints(t):
    return q.constraint_report(shaped(t), ["status"], {"open_or_big": "status = 'O' OR amount > 2000"})


@query("schema_enforce", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment, true AS refused FROM customer")
def schema_enforce(t):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("c_custkey BIGINT, c_name STRING, c_mktsegment STRING")
    rows = t.customer.select("c_custkey", "c_name")
    try:
        q.enforce_schema(t.customer, schema)
        refused = False
    except q.SchemaMismatch:
        refused = True
    return q.enforce_schema(rows, schema).withColumn("refused", F.lit(refused))


@query("schema_merge", """
    SELECT c_custkey AS id, c_name AS name, NULL AS acctbal FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def schema_merge(t):
    table = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    rows = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return q.merge_schema(table, rows)


@query("generated_cols", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, year(o_orderdate) AS order_year FROM orders""")
def generated_cols(t):
    made = q.generated(t.orders, {"order_day": "CAST(o_orderdate AS DATE)", "order_year": "year(o_orderdate)"})
    return made.select("o_orderkey", "order_day", "order_year")


@query("surrogate_key", """
    SELECT count(*) AS n, count(*) AS n_ids, max(o_orderkey) + 1 AS first_id, max(o_orderkey) + count(*) AS last_id FROM orders""")
def surrogate_key(t):
    top = t.orders.agg(F.max("o_orderkey").alias("m")).first()["m"]
    keyed = q.surrogate_key(t.orders.select("o_custkey", "o_totalprice").repartition(8), "id", after=top)
    return keyed.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query("medallion", """
    SELECT date_trunc('month', o_orderdate) AS month, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_totalprice > 1000 GROUP BY ALL""")
def medallion(t):
    raw = layers.bronze(t.orders)
    twice = raw.unionAll(raw)
    clean = layers.silver(twice, {"key": "o_orderkey IS NOT NULL", "amount": "o_totalprice > 1000"}, ["o_orderkey"])
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    return clean.groupBy(month, "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("gold_daily_revenue", """
    SELECT r_name AS region, CAST(o_orderdate AS DATE) AS day, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
           count(*) AS n_lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def gold_daily_revenue(t):
    return layers.daily_revenue(t.lineitem, t.orders, t.customer, t.nation, t.region)


@query("mv_dim_join", """
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def mv_dim_join(t):
    joined = layers.rejoin_dimension(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("row_count_gate", """
    SELECT count(*) AS n_rows, CASE WHEN count(*) >= 100 THEN 'publish' ELSE 'quarantine' END AS decision
    FROM orders WHERE o_orderstatus = 'O'""")
def row_count_gate(t):
    return q.row_count_gate(t.orders.filter("o_orderstatus = 'O'"), 100)


@query("sql_alert", """
    WITH a AS (SELECT CAST(count(*) AS DOUBLE) AS v FROM events WHERE event_type = 'error'),
         b AS (SELECT CAST(max(o_totalprice) AS DOUBLE) AS v FROM orders)
    SELECT 'errors' AS alert, v AS value, 100.0 AS threshold, v >= 100 AS fired FROM a
    UNION ALL SELECT 'largest_order', v, 1e9, v > 1e9 FROM b""")
def sql_alert(t):
    errors = t.events.filter("event_type = 'error'").agg(F.count(F.lit(1)).alias("v"))
    largest = t.orders.agg(F.max("o_totalprice").alias("v"))
    return q.sql_alerts([("errors", errors, ">=", 100), ("largest_order", largest, ">", 1e9)])
