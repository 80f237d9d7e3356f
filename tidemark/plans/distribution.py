"""Partitioning control; every query proves that no row is lost."""

from pyspark.sql import functions as F

from ..operators import distribution as dist
from ..session import materialize
from .registry import query

CONTENT = "SELECT count(*) AS n, sum(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total FROM orders"


def _content(df):
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("repartition_key", CONTENT)
def repartition_key(t):
    return _content(dist.repartition_key(t.orders, ["o_custkey"], 16, share=0.1))


@query("repartition_n", CONTENT)
def repartition_n(t):
    return _content(dist.repartition_n(t.orders, 12))


@query("coalesce_n", CONTENT)
def coalesce_n(t):
    return _content(dist.coalesce_n(t.orders.repartition(12), 3))


@query("hint_rebalance", CONTENT)
def hint_rebalance(t):
    return _content(dist.rebalance(t.orders, "o_orderstatus"))


@query("partition_profile", "SELECT 6 AS partitions, count(*) AS n_rows, true AS even FROM orders")
def partition_profile(t):
    profile = dist.partition_profile(t.orders.repartition(6))
    even = F.col("max_rows") <= 2 * F.col("median_rows")
    return profile.select("partitions", "n_rows", even.alias("even"))


@query("cache_reuse", """
    SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS all_rows
    FROM orders WHERE o_totalprice > 1000 GROUP BY 1""")
def cache_reuse(t):
    with dist.reused(t.orders.filter("o_totalprice > 1000").select("o_orderkey", "o_orderstatus")) as kept:
        total = kept.count()
        counted = kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
        return materialize(counted.withColumn("all_rows", F.lit(total)), "cache-reuse")
