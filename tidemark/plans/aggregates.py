"""Aggregations, deduplication, sorting and set operations."""

from pyspark.sql import functions as F

from ..operators import ordered, skew
from ..operators import relational as rel
from .registry import query


@query("agg_group", """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean,
           max(o_totalprice) AS top FROM orders GROUP BY 1""")
def agg_group(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.max("o_totalprice").alias("top"),
    )


@query("agg_global", """
    SELECT count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, max(l_shipdate) AS last_ship
    FROM lineitem""")
def agg_global(t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query("agg_count_distinct", """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
           count(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM lineitem GROUP BY 1""")
def agg_count_distinct(t):
    # Each pair once; the counts of single columns then go over pairs, not rows.
    pairs = t.lineitem.select("l_returnflag", "l_partkey", "l_suppkey").distinct()
    return pairs.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.count_if(F.col("l_partkey").isNotNull() & F.col("l_suppkey").isNotNull()).alias("pairs"),
    )


@query("agg_approx_distinct", """
    SELECT l_returnflag, true AS close FROM lineitem GROUP BY 1""")
def agg_approx_distinct(t):
    both = t.lineitem.groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_partkey", 0.02).alias("approx"), F.countDistinct("l_partkey").alias("exact")
    )
    return both.select("l_returnflag", (F.abs(F.col("approx") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"))


@query("agg_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def agg_distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("agg_having", """
    SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 14""")
def agg_having(t):
    n = t.events.filter("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return n.filter("n >= 14")


@query("agg_collect_set", """
    SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds, max(ts) AS last_seen
    FROM events GROUP BY 1""")
def agg_collect_set(t):
    return t.events.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"), F.max("ts").alias("last_seen")
    )


@query("agg_expression_key", """
    SELECT date_trunc('month', o_orderdate) AS month, o_orderkey % 100 AS slot, count(*) AS n
    FROM orders GROUP BY ALL""")
def agg_expression_key(t):
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    return t.orders.groupBy(month, (F.col("o_orderkey") % 100).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_day", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def agg_day(t):
    return t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("agg_ratio", """
    SELECT o_orderpriority, round(sum(o_totalprice) / count(*), 4) AS avg_order FROM orders GROUP BY 1""")
def agg_ratio(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.round(F.sum("o_totalprice") / F.count(F.lit(1)), 4).alias("avg_order")
    )


def _skewed(t):
    from ..sources.generate import skewed_key_modulo

    return t.orders.withColumn("key", skewed_key_modulo("o_orderkey", 7, 50))


SKEWED = "(SELECT *, CASE WHEN o_orderkey % 10 < 7 THEN 0 ELSE o_orderkey % 50 + 1 END AS key FROM orders)"


@query("agg_salted", f"""
    SELECT key, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderdate) AS first_day,
           max(o_orderdate) AS last_day FROM {SKEWED} GROUP BY 1""")
def agg_salted(t):
    measures = {
        "n": ("count", "*"), "total": ("sum", "o_totalprice"),
        "first_day": ("min", "o_orderdate"), "last_day": ("max", "o_orderdate"),
    }
    return skew.agg_salted(_skewed(t), ["key"], measures).withColumn("total", F.round("total", 2))


@query("agg_salted_avg", f"""
    SELECT key, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean_cents FROM {SKEWED} GROUP BY 1""")
def agg_salted_avg(t):
    # Whole cents: their sum is exact in any order, so the mean needs no rounding.
    cents = _skewed(t).withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    return skew.agg_salted(cents, ["key"], {"mean_cents": ("avg", "cents")})


@query("agg_pivot", """
    SELECT l_linestatus, round(sum(l_quantity) FILTER (l_returnflag = 'A'), 2) AS a,
           round(sum(l_quantity) FILTER (l_returnflag = 'N'), 2) AS n,
           round(sum(l_quantity) FILTER (l_returnflag = 'R'), 2) AS r FROM lineitem GROUP BY 1""")
def agg_pivot(t):
    wide = t.lineitem.groupBy("l_linestatus").pivot("l_returnflag", ["A", "N", "R"]).agg(F.round(F.sum("l_quantity"), 2))
    return wide.toDF("l_linestatus", "a", "n", "r")


@query("agg_unpivot", """
    SELECT p_partkey, 'size' AS name, CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part""")
def agg_unpivot(t):
    wide = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return wide.unpivot("p_partkey", ["size", "price"], "name", "value")


@query("skew_report", f"""
    WITH c AS (SELECT key, count(*) AS n FROM {SKEWED} GROUP BY 1),
         s AS (SELECT count(*) AS n_keys, sum(n) AS n_rows, max(n) AS max_rows, quantile_cont(n, 0.5) AS median_rows,
                      quantile_cont(n, 0.75) AS p75_rows FROM c)
    SELECT *, round(max_rows / median_rows, 6) AS max_over_median, round(max_rows / n_rows, 6) AS top_share FROM s""")
def skew_report(t):
    return skew.skew_report(_skewed(t), ["key"])


@query("skew_top_keys", f"""
    SELECT key, count(*) AS n_rows FROM {SKEWED} GROUP BY 1 ORDER BY n_rows DESC, key LIMIT 5""")
def skew_top_keys(t):
    return skew.key_shares(_skewed(t), ["key"], 5)


@query("dedup_latest", """
    SELECT user_id, event_id, ts, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def dedup_latest(t):
    rows = t.events.select("user_id", "event_id", "ts", "event_type")
    return ordered.latest(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("dedup_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def dedup_keys(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_quantity").dropDuplicates(["l_partkey", "l_suppkey"]).select(
        "l_partkey", "l_suppkey"
    )


@query("sort_multi", """
    SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS status FROM orders""")
def sort_multi(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    # The unique key ends the sort, so equal values still spread over the range partitions.
    return rows.orderBy(F.desc("o_orderpriority"), F.asc_nulls_last("status"), "o_orderkey")


@query("top_k", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_k(t):
    return rel.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


@query("limit_sample", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 100)")
def limit_sample(t):
    return t.orders.limit(100).agg(F.count(F.lit(1)).alias("n"))


@query("union_all", """
    SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def union_all(t):
    return rel.combine(
        t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal")),
        t.supplier.select("s_nationkey", "s_acctbal"),
        "union",
    )


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(t):
    return rel.combine(
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
        "union_by_name",
    )


@query("intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect(t):
    return rel.combine(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"), "intersect")


@query("except", """
    SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 25""")
def except_(t):
    line = t.lineitem
    return rel.combine(
        line.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")),
        line.filter("l_returnflag = 'A' AND l_quantity > 25").select("l_partkey"),
        "except",
    )


@query("intersect_all", """
    SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier""")
def intersect_all(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey")
    return rel.combine(a, b, "intersect", keep_copies=True)


@query("except_all", """
    SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier""")
def except_all(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey")
    return rel.combine(a, b, "except", keep_copies=True)
