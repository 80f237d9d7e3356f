"""Joins: strategies, salting, ranges, points in time and pruning."""

from pyspark.sql import functions as F

from ..operators import relational as rel
from ..operators import skew
from ..sources import files
from .registry import query

ORDER_SUMS = """
    SELECT o_orderpriority, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


def _order_sums(joined):
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


def _sides(t):
    line = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice")
    order = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    return line, order


@query("join_inner", """
    SELECT l_orderkey, l_partkey, l_linenumber, o_custkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return joined.select("l_orderkey", "l_partkey", "l_linenumber", "o_custkey", "o_orderpriority")


def _outer(how, sql):
    @query(f"join_outer_{how}", f"""
        WITH o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000),
             c AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0)
        SELECT c_custkey, c_name, o_orderkey, o_custkey FROM c {sql} JOIN o ON c_custkey = o_custkey""")
    def build(t):
        o = t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_custkey")
        c = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name")
        return c.join(o, F.col("c_custkey") == F.col("o_custkey"), how)

    return build


_outer("left", "LEFT")
_outer("right", "RIGHT")
_outer("full", "FULL")


@query("join_outer", """
    WITH o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000),
         c AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    SELECT 'left' AS how, count(*) AS n, count(c_custkey) AS n_left, count(o_orderkey) AS n_right FROM c LEFT JOIN o ON c_custkey = o_custkey
    UNION ALL SELECT 'right', count(*), count(c_custkey), count(o_orderkey) FROM c RIGHT JOIN o ON c_custkey = o_custkey
    UNION ALL SELECT 'full', count(*), count(c_custkey), count(o_orderkey) FROM c FULL JOIN o ON c_custkey = o_custkey""")
def join_outer(t):
    o = t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_custkey")
    c = t.customer.filter("c_acctbal > 0").select("c_custkey")
    parts = [
        c.join(o, F.col("c_custkey") == F.col("o_custkey"), how).agg(
            F.lit(how).alias("how"), F.count(F.lit(1)).alias("n"), F.count("c_custkey").alias("n_left"), F.count("o_orderkey").alias("n_right")
        )
        for how in ("left", "right", "full")
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("join_using", """
    SELECT custkey, c_name, o_orderkey FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders)
    JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)""")
def join_using(t):
    o = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    c = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    return o.join(c, "custkey").select("custkey", "c_name", "o_orderkey")


@query("join_broadcast", """
    SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def join_broadcast(t):
    joined = rel.join_broadcast(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("join_hints", ORDER_SUMS)
def join_hints(t):
    line, order = _sides(t)
    return _order_sums(rel.join_hinted(line, order, "orderkey", "inner", "merge"))


@query("join_shuffle_hash", ORDER_SUMS)
def join_shuffle_hash(t):
    line, order = _sides(t)
    return _order_sums(rel.join_hinted(line, order, "orderkey", "inner", "shuffle_hash"))


@query("join_non_equi", """
    SELECT r.r_name AS from_region, q.r_name AS to_region, count(*) AS n
    FROM region r JOIN region q ON r.r_regionkey < q.r_regionkey
    JOIN nation ON n_regionkey = r.r_regionkey GROUP BY ALL""")
def join_non_equi(t):
    a = t.region.select(F.col("r_regionkey").alias("a_key"), F.col("r_name").alias("from_region"))
    b = t.region.select(F.col("r_regionkey").alias("b_key"), F.col("r_name").alias("to_region"))
    pairs = rel.join_unequal(a, b, F.col("a_key") < F.col("b_key"))
    found = t.nation.join(pairs, F.col("n_regionkey") == F.col("a_key"))
    return found.groupBy("from_region", "to_region").agg(F.count(F.lit(1)).alias("n"))


PRICE_CTE = """
    price AS (
      SELECT p_brand AS brand, TIMESTAMP '1995-01-01' AS price_start, TIMESTAMP '1998-06-30 23:59:59' AS price_end,
             round(avg(p_retailprice), 2) AS unit_price FROM part GROUP BY 1
      UNION ALL
      SELECT p_brand, TIMESTAMP '1998-07-01', CAST(NULL AS TIMESTAMP), round(avg(p_retailprice) * 1.1, 2)
      FROM part GROUP BY 1),
    usage AS (SELECT p_brand AS brand, l_shipdate AS used_at, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def price_list(t):
    base = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.avg("p_retailprice").alias("p"))
    first = base.select(
        "brand", F.lit("1995-01-01").cast("timestamp_ntz").alias("price_start"),
        F.lit("1998-06-30 23:59:59").cast("timestamp_ntz").alias("price_end"), F.round("p", 2).alias("unit_price"),
    )
    second = base.select(
        "brand", F.lit("1998-07-01").cast("timestamp_ntz").alias("price_start"),
        F.lit(None).cast("timestamp_ntz").alias("price_end"), F.round(F.col("p") * 1.1, 2).alias("unit_price"),
    )
    return first.unionAll(second)


def usage(t):
    line = t.lineitem.select("l_partkey", F.col("l_shipdate").alias("used_at"), "l_quantity")
    part = t.part.select("p_partkey", F.col("p_brand").alias("brand"))
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("brand", "used_at", "l_quantity")


@query("join_range_price", f"""
    WITH {PRICE_CTE}
    SELECT u.brand, p.price_start, count(*) AS n, round(sum(l_quantity), 2) AS qty
    FROM usage u JOIN price p ON u.brand = p.brand
     AND used_at >= price_start AND (price_end IS NULL OR used_at <= price_end) GROUP BY ALL""")
def join_range_price(t):
    joined = rel.join_range(
        usage(t), price_list(t), ["brand"], "used_at", "price_start", "price_end", "month"
    )
    return joined.groupBy("brand", "price_start").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query("join_semi", """
    SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def join_semi(t):
    p = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(p, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("join_anti", """
    SELECT p_partkey FROM part WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 40)""")
def join_anti(t):
    big = t.lineitem.filter("l_quantity > 40").select("l_partkey")
    return t.part.join(big, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@query("join_semi_anti", """
    WITH p AS (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)
    SELECT c_custkey, c_name, c_custkey IN (SELECT o_custkey FROM p) AS has_big_order FROM customer""")
def join_semi_anti(t):
    big = t.orders.filter("o_totalprice > 250000").select("o_custkey")
    who, match = t.customer.select("c_custkey", "c_name"), F.col("c_custkey") == F.col("o_custkey")
    semi = who.join(big, match, "left_semi").withColumn("has_big_order", F.lit(True))
    return semi.unionAll(who.join(big, match, "left_anti").withColumn("has_big_order", F.lit(False)))


@query("join_bucketed", """
    SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def join_bucketed(t):
    left, right = t.scratch("orders-b"), t.scratch("customer-b")
    names = ["tm_" + p.rsplit("-", 1)[1] for p in (left, right)]
    o = t.orders.select(F.col("o_custkey").alias("custkey"), "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    joined = skew.join_bucketed(o, c, ["custkey"], names, [left, right], buckets=8)
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("join_dpp", """
    SELECT seg_status, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN (SELECT DISTINCT o_orderstatus AS seg_status FROM orders WHERE o_totalprice > 0
                      AND o_orderstatus <> 'P') ON o_orderstatus = seg_status GROUP BY 1""")
def join_dpp(t):
    path = t.scratch("orders-by-status")
    files.write_partitioned(t.orders, path, ["o_orderstatus"])
    fact = t.spark.read.parquet(path)
    wanted = t.orders.filter("o_totalprice > 0 AND o_orderstatus <> 'P'").select(F.col("o_orderstatus").alias("seg_status"))
    joined = fact.join(wanted.distinct(), F.col("o_orderstatus") == F.col("seg_status"))
    return joined.groupBy("seg_status").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


SKEWED_SQL = """
    WITH f AS (SELECT CASE WHEN o_orderkey % 10 < 7 THEN 0 ELSE o_orderkey % 50 + 1 END AS custkey, o_totalprice FROM orders)
    SELECT c_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM f JOIN (SELECT c_custkey AS custkey, c_name, c_mktsegment FROM customer) USING (custkey) GROUP BY ALL"""


def _skewed(t):
    from ..sources.generate import skewed_key_modulo

    fact = t.orders.select("o_orderkey", skewed_key_modulo("o_orderkey", 7, 50).alias("custkey"), "o_totalprice")
    dim = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return fact, dim


def _skewed_sums(joined):
    return joined.groupBy("c_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("join_salted", SKEWED_SQL)
def join_salted(t):
    fact, dim = _skewed(t)
    return _skewed_sums(skew.join_salted(fact, dim, ["custkey"], salts=32, share=0.05))


@query("join_salted_full", SKEWED_SQL)
def join_salted_full(t):
    fact, dim = _skewed(t)
    return _skewed_sums(skew.join_salted_full(fact, dim, ["custkey"], salts=8))


@query("join_point_in_time", """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, (ts, event_id)) AS kind FROM events GROUP BY ALL),
         v AS (SELECT user_id, kind, CAST(day AS TIMESTAMP) AS s,
                      CAST(lead(day) OVER (PARTITION BY user_id ORDER BY day) AS TIMESTAMP) AS e FROM d)
    SELECT event_id, ev.user_id, event_type, kind FROM events ev JOIN v
      ON ev.user_id = v.user_id AND ev.ts >= s AND (ev.ts < e OR e IS NULL)""")
def join_point_in_time(t):
    from ..operators.ordered import neighbours

    daily = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("kind")
    )
    history = neighbours(daily, ["user_id"], ["day"], ["day"]).select(
        "user_id", "kind", F.col("day").cast("timestamp_ntz").alias("__START_AT"),
        F.col("_next.day").cast("timestamp_ntz").alias("__END_AT"),
    )
    fact = t.events.select("event_id", "user_id", "event_type", "ts")
    found = rel.join_point_in_time(fact, history, ["user_id"], "ts", unit="day")
    return found.select("event_id", "user_id", "event_type", "kind")
