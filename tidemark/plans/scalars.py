"""Scalar functions, SQL functions and table functions."""

from pyspark.sql import functions as F

from ..functions import scalar
from .registry import query


@query("fn_string", """
    SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, upper(c_mktsegment) AS up, lower(trim(c_name)) AS low,
           substring(c_name, 1, 4) AS head, left(c_mktsegment, 1) AS initial, right(c_name, 4) AS tail,
           split_part(c_name, '#', 2) AS number, repeat('x', 3) AS pad, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits
    FROM customer""")
def fn_string(t):
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.upper("c_mktsegment").alias("up"),
        F.lower(F.trim("c_name")).alias("low"),
        F.substring("c_name", 1, 4).alias("head"),
        F.left("c_mktsegment", F.lit(1)).alias("initial"),
        F.right("c_name", F.lit(4)).alias("tail"),
        F.split("c_name", "#").getItem(1).alias("number"),
        F.repeat(F.lit("x"), 3).alias("pad"),
        scalar.digits_only("c_name").alias("digits"),
    )


@query("fn_datetime", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + 7 AS week_on,
           date_trunc('month', o_orderdate) AS month_start, year(o_orderdate) AS y, month(o_orderdate) AS m,
           o_orderdate - INTERVAL 36 HOURS AS earlier, epoch_ms(o_orderkey * 1000) AS from_millis
    FROM orders""")
def fn_datetime(t):
    return t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.date_add(F.to_date("o_orderdate"), 7).alias("week_on"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month_start"),
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        (F.col("o_orderdate") - F.expr("INTERVAL 36 HOURS")).alias("earlier"),
        F.timestamp_millis(F.col("o_orderkey") * 1000).cast("timestamp_ntz").alias("from_millis"),
    )


@query("fn_math", """
    SELECT p_partkey, round(p_retailprice / 7, 2) AS seventh, p_partkey % 13 AS slot,
           round(CASE WHEN p_size < 10 THEN 256.0 WHEN p_size > 40 THEN 1024.0
                 ELSE 256.0 + (p_size - 10) / 30.0 * 768.0 END, 6) AS scaled, true AS in_unit FROM part""")
def fn_math(t):
    return t.part.select(
        "p_partkey",
        F.round(F.col("p_retailprice") / 7, 2).alias("seventh"),
        (F.col("p_partkey") % 13).alias("slot"),
        F.round(scalar.interpolate(F.col("p_size").cast("double"), 10, 256, 40, 1024), 6).alias("scaled"),
        F.rand(11).between(0, 1).alias("in_unit"),
    )


@query("fn_conditional", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 50000 THEN 'mid' ELSE 'low' END AS band,
           CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status
    FROM orders""")
def fn_conditional(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(price > 200000, "high").when(price > 50000, "mid").otherwise("low").alias("band"),
        F.expr("IF(o_orderstatus = 'O', 1, 0)").alias("is_open"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("pending")).alias("status"),
    )


@query("fn_array_map", """
    SELECT event_id, ['a', 'b', 'c', 'd'][event_id % 4 + 1] AS letter, CAST(json_extract(props, '$.k') AS INT) AS k,
           unnest([1, 2]) AS part FROM events""")
def fn_array_map(t):
    letters = F.array(*[F.lit(x) for x in "abcd"])
    parsed = F.from_json("props", "MAP<STRING, INT>")
    shaped = t.events.select(
        "event_id", F.element_at(letters, (F.col("event_id") % 4 + 1).cast("int")).alias("letter"), parsed.alias("m"),
        F.struct(F.lit(1).alias("lo"), F.lit(2).alias("hi")).alias("s"),
    )
    return shaped.select(
        "event_id", "letter", F.col("m")["k"].alias("k"), F.explode(F.sequence(F.col("s.lo"), F.col("s.hi"))).alias("part")
    )


@query("fn_json_variant", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, '{"k":' || json_extract_string(props, '$.k') || '}' AS again,
           CAST(json_extract(props, '$.k') AS INT) AS via_variant, 'BIGINT' AS kind FROM events""")
def fn_json_variant(t):
    parsed = t.events.select(
        "event_id", F.from_json("props", "k INT").alias("p"), F.parse_json("props").alias("v")
    )
    inner = F.variant_get("v", "$.k", "variant")
    return parsed.select(
        "event_id", F.col("p.k").alias("k"), F.to_json("p").alias("again"),
        F.variant_get("v", "$.k", "int").alias("via_variant"), F.schema_of_variant(inner).alias("kind"),
    )


@query("date_dim", """
    SELECT CAST(day AS DATE) AS day, year(day) AS y, month(day) AS m FROM (
      SELECT unnest(range(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
      FROM orders)""")
def date_dim(t):
    span = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    days = span.select(*scalar.date_dim(F.col("a"), F.col("b")))
    return days.select("day", F.year("day").alias("y"), F.month("day").alias("m"))


@query("udf_sql_scalar", """
    SELECT o_orderkey, round(o_totalprice * 1.2, 4) AS gross, 'dept_' || lower(o_orderstatus) AS label FROM orders""")
def udf_sql_scalar(t):
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tm_gross(x DOUBLE) RETURNS DOUBLE RETURN round(x * 1.2, 4)")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tm_label(s STRING) RETURNS STRING RETURN concat('dept_', lower(s))")
    return t.orders.selectExpr("o_orderkey", "tm_gross(o_totalprice) AS gross", "tm_label(o_orderstatus) AS label")


@query("udf_python", """
    SELECT c_custkey, regexp_replace('+49 (' || c_custkey || ') ' || c_name, '[^0-9]', '', 'g') AS phone,
           repeat('*', length(replace(c_name, '#', '.'))) || '@mail.example' AS email FROM customer""")
def udf_python(t):
    raw = t.customer.select(
        "c_custkey",
        F.concat(F.lit("+49 ("), F.col("c_custkey").cast("string"), F.lit(") "), "c_name").alias("phone"),
        F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@mail.example")).alias("email"),
    )
    return raw.select("c_custkey", scalar.digits_only("phone").alias("phone"), scalar.star_local_part("email").alias("email"))


@query("udtf_sql", """
    SELECT c_nationkey, c_custkey, c_acctbal FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
      FROM customer WHERE c_mktsegment = 'BUILDING') WHERE rn <= 3""")
def udtf_sql(t):
    t.customer.createOrReplaceTempView("tm_customers")
    t.spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION tm_top(segment STRING, n INT)
        RETURNS TABLE (c_nationkey INT, c_custkey BIGINT, c_acctbal DOUBLE)
        RETURN SELECT c_nationkey, c_custkey, c_acctbal FROM (
            SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
            FROM tm_customers WHERE c_mktsegment = tm_top.segment) WHERE rn <= tm_top.n""")
    return t.spark.sql("SELECT * FROM tm_top('BUILDING', 3)")


@query("udf_lookup_broadcast", """
    SELECT coalesce(label, 'UNKNOWN') AS label, count(*) AS n FROM events
    LEFT JOIN (VALUES ('click', 'C'), ('view', 'V'), ('purchase', 'P')) v(k, label) ON event_type = k GROUP BY 1""")
def udf_lookup_broadcast(t):
    named = scalar.lookup(t.events, "event_type", {"click": "C", "view": "V", "purchase": "P"}, "label")
    return named.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("udf_arith_null_safe", """
    SELECT event_id, round(coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0) * 1.5, 6) AS scaled FROM events""")
def udf_arith_null_safe(t):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", F.round(scalar.null_safe_scale(value, 1.5), 6).alias("scaled"))


@query("map_batches", """
    SELECT o_orderkey, round(o_totalprice * 0.19, 4) AS tax FROM orders""")
def map_batches(t):
    def tax(batch):
        return batch.assign(tax=(batch["o_totalprice"] * 0.19))[["o_orderkey", "tax"]]

    taxed = scalar.map_batches(t.orders.select("o_orderkey", "o_totalprice"), tax, "o_orderkey long, tax double")
    return taxed.withColumn("tax", F.round("tax", 4))
