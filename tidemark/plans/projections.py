"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from ..operators import relational as rel
from .registry import query

EVENTS_NOW = "2024-01-30 00:00:00"


@query("project", """
    SELECT o_orderkey AS order_id, o_totalprice * 0.1 AS tax, upper(o_orderstatus) AS status, o_custkey
    FROM orders""")
def project(t):
    df = t.orders.withColumn("tax", F.col("o_totalprice") * 0.1).withColumn("status", F.upper("o_orderstatus"))
    return df.withColumnRenamed("o_orderkey", "order_id").select("order_id", "tax", "status", "o_custkey")


@query("filter_basic", """
    SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem
    WHERE (l_quantity >= 30 AND l_discount > 0.05) OR l_returnflag = 'R'""")
def filter_basic(t):
    df = t.lineitem.where("(l_quantity >= 30 AND l_discount > 0.05) OR l_returnflag = 'R'")
    return df.select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query("filter_in_between", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 1000 AND 50000""")
def filter_in_between(t):
    df = t.orders.filter(F.col("o_orderstatus").isin("F", "P") & F.col("o_totalprice").between(1000, 50000))
    return df.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("filter_null", """
    WITH d AS (SELECT nullif(event_type, 'error') AS kind, user_id FROM events)
    SELECT user_id, count(*) AS n_rows, count(kind) AS n_present, sum(CASE WHEN kind IS NULL THEN 1 ELSE 0 END) AS n_null
    FROM d GROUP BY 1""")
def filter_null(t):
    d = t.events.select("user_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return d.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("kind").alias("n_present"),
        F.count_if(F.col("kind").isNull()).alias("n_null"),
    )


@query("filter_pattern", """
    SELECT p_partkey, p_name FROM part
    WHERE p_name ILIKE '%RING%' AND NOT (p_type ILIKE 'econ%' OR p_type ILIKE '%ROMO')""")
def filter_pattern(t):
    unwanted = rel.any_ilike("p_type", ["econ%", "%ROMO"])
    return t.part.filter(F.col("p_name").ilike("%RING%") & ~unwanted).select("p_partkey", "p_name")


@query("filter_pattern_text", """
    SELECT doc_id, lang, source FROM documents WHERE text ILIKE '%the%' AND NOT (text ILIKE '%copyright%')""")
def filter_pattern_text(t):
    return t.documents.filter(F.col("text").ilike("%the%") & ~F.col("text").ilike("%copyright%")).select(
        "doc_id", "lang", "source"
    )


@query("filter_relative_time", f"""
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 7 DAYS
      AND ts < TIMESTAMP '{EVENTS_NOW}'""")
def filter_relative_time(t):
    return rel.within_last(t.events, "ts", EVENTS_NOW, days=7).select("event_id", "ts")


@query("filter_exists", """
    SELECT c_custkey, c_mktsegment FROM customer c WHERE EXISTS (
      SELECT 1 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE n.n_nationkey = c.c_nationkey AND lower(r.r_name) = lower('Asia'))""")
def filter_exists(t):
    allowed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).filter(
        F.lower("r_name") == F.lower(F.lit("Asia"))
    )
    kept = t.customer.join(allowed, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return kept.select("c_custkey", "c_mktsegment")


@query("filter_in_subquery", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def filter_in_subquery(t):
    rich = t.customer.filter("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    return rel.in_set(t.orders.select("o_orderkey", "o_custkey"), rich, ["o_custkey"])


@query("filter_not_in", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)""")
def filter_not_in(t):
    big = t.orders.filter("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return rel.not_in_set(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query("filter_not_in_null", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END FROM orders)""")
def filter_not_in_null(t):
    keys = t.orders.select(F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("c_custkey"))
    return rel.not_in_set(t.customer.select("c_custkey", "c_name"), keys, "c_custkey")


@query("filter_absent", """
    SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 100000)""")
def filter_absent(t):
    big = t.orders.filter("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return rel.absent_from(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query("param_query", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'O' AND o_totalprice >= 50000 AND o_orderdate >= DATE '1998-01-01'""")
def param_query(t):
    import datetime

    text = """SELECT o_orderkey, o_totalprice FROM {orders}
              WHERE o_orderstatus = :status AND o_totalprice >= :floor AND o_orderdate >= :since"""
    values = {"status": "O", "floor": 50000.0, "since": datetime.date(1998, 1, 1)}
    return rel.param_query(t.spark, text, values, orders=t.orders)


@query("identifier_param", """
    SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1""")
def identifier_param(t):
    t.customer.createOrReplaceTempView("tm_customer")
    text = """SELECT IDENTIFIER(:by) AS segment, count(*) AS n, round(sum(IDENTIFIER(:measure)), 2) AS total
              FROM IDENTIFIER(:source) GROUP BY 1"""
    return t.spark.sql(text, args={"by": "c_mktsegment", "measure": "c_acctbal", "source": "tm_customer"})


@query("cte_chain", """
    WITH valid AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 0),
         per_cust AS (SELECT o_custkey, sum(o_totalprice) AS spent, count(*) AS n FROM valid GROUP BY 1),
         per_seg AS (SELECT c_mktsegment, sum(spent) AS revenue, sum(n) AS n_orders
                     FROM per_cust JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT c_mktsegment, round(revenue, 2) AS revenue, n_orders, round(revenue / n_orders, 4) AS avg_order FROM per_seg""")
def cte_chain(t):
    text = """
        WITH valid AS (SELECT o_custkey, o_totalprice FROM {orders} WHERE o_totalprice > 0),
             per_cust AS (SELECT o_custkey, sum(o_totalprice) AS spent, count(*) AS n FROM valid GROUP BY 1),
             per_seg AS (SELECT c_mktsegment, sum(spent) AS revenue, sum(n) AS n_orders
                         FROM per_cust JOIN {customer} ON o_custkey = c_custkey GROUP BY 1)
        SELECT c_mktsegment, round(revenue, 2) AS revenue, n_orders, round(revenue / n_orders, 4) AS avg_order
        FROM per_seg"""
    return t.spark.sql(text, orders=t.orders, customer=t.customer)


@query("safe_cast", """
    SELECT doc_id, TRY_CAST(replace(source, 'src', '') AS INT) AS source_no, TRY_CAST(lang AS INT) AS lang_no,
           CASE WHEN n_chars - 100 = 0 THEN NULL ELSE round(n_chars / (n_chars - 100.0), 6) END AS ratio
    FROM documents""")
def safe_cast(t):
    return t.documents.select(
        "doc_id",
        F.replace("source", F.lit("src"), F.lit("")).try_cast("int").alias("source_no"),
        F.col("lang").try_cast("int").alias("lang_no"),
        F.round(F.try_divide(F.col("n_chars"), F.col("n_chars") - 100.0), 6).alias("ratio"),
    )
