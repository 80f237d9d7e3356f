"""Plans have the nodes we rely on at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tidemark.operators import relational as rel
from tidemark.operators import merge as m
from tidemark.operators.sizes import broadcast_if_small, measured_bytes
from tidemark.plans.registry import all_queries

QUERIES = all_queries()


@pytest.fixture
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_broadcast_join_leaves_the_fact_alone(tables, no_automatic_broadcast):
    text = plan(rel.join_broadcast(tables.customer, tables.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_large_side_is_not_broadcast(tables, no_automatic_broadcast):
    small = broadcast_if_small(tables.lineitem, limit=1000)
    text = plan(tables.orders.join(small, F.col("l_orderkey") == F.col("o_orderkey")))
    assert "SortMergeJoin" in text


def test_measured_bytes_follow_the_rows(tables):
    assert measured_bytes(tables.lineitem) > measured_bytes(tables.nation) > 0


@pytest.mark.parametrize("strategy, node", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"), ("broadcast", "BroadcastHashJoin")])
def test_strategies(tables, no_automatic_broadcast, strategy, node):
    a = tables.lineitem.withColumnRenamed("l_orderkey", "k")
    b = tables.orders.withColumnRenamed("o_orderkey", "k")
    assert node in plan(rel.join_hinted(a, b, "k", "inner", strategy))


def test_a_large_side_of_an_unequal_join_is_refused(tables):
    from tidemark.operators import relational as rel

    with pytest.raises(ValueError, match="limited"):
        rel.join_unequal(tables.region, tables.orders, F.col("r_regionkey") < F.col("o_orderkey"), limit=10_000)


def test_unknown_strategy(tables):
    with pytest.raises(ValueError):
        rel.join_hinted(tables.orders, tables.orders, "o_orderkey", "inner", "sort")


def test_filters_and_columns_reach_the_scan(spark):
    from conftest import ROOT

    text = plan(QUERIES["filter_in_between"](spark, ROOT))
    assert "In(o_orderstatus, [F,P])" in text.split("PushedFilters")[1]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_time_filter_reaches_the_scan(spark):
    from conftest import ROOT

    assert "GreaterThanOrEqual(ts" in plan(QUERIES["filter_relative_time"](spark, ROOT))


def test_bucketed_join_needs_no_exchange(spark, tables, folder):
    from tidemark.sources.files import write_bucketed

    o = tables.orders.select(F.col("o_custkey").alias("k"), "o_totalprice")
    c = tables.customer.select(F.col("c_custkey").alias("k"), "c_name")
    for n, (df, name) in enumerate([(o, "plan_orders"), (c, "plan_customer")]):
        write_bucketed(df, name, f"{folder}-{n}", 4, ["k"])
    text = plan(spark.table("plan_orders").hint("merge").join(spark.table("plan_customer"), "k"))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert len(spark.table("plan_orders").inputFiles()) == 4


def test_partition_pruning_at_run_time(spark, tables, folder, no_automatic_broadcast):
    tables.orders.write.partitionBy("o_orderstatus").parquet(folder)
    wanted = F.broadcast(tables.orders.filter("o_totalprice > 400000").select(F.col("o_orderstatus").alias("s")).distinct())
    joined = spark.read.parquet(folder).join(wanted, F.col("o_orderstatus") == F.col("s"))
    assert "dynamicpruning" in plan(joined)


def test_aggregates_are_partial_first(spark):
    from conftest import ROOT

    assert "partial_sum" in plan(QUERIES["agg_group"](spark, ROOT))


def test_top_k_is_not_a_full_sort(spark):
    from conftest import ROOT

    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, ROOT))


def test_merge_uses_joins_that_can_be_split(tables, no_automatic_broadcast):
    text = plan(m.upsert(tables.customer, tables.customer, ["c_custkey"], guard=False))
    assert "FullOuter" not in text and "LeftOuter" in text and "LeftAnti" in text


def test_cached_result_is_reused(tables):
    from tidemark.operators.distribution import reused

    with reused(tables.orders.filter("o_totalprice > 5")) as kept:
        assert "InMemoryTableScan" in plan(kept.groupBy("o_orderstatus").count())



def test_change_feed_aggregates_numbers_only(spark):
    from tidemark.operators import versions as v

    log = spark.createDataFrame([("a", 1, "I", "x"), ("a", 2, "U", "y"), ("b", 2, "I", "z")], "id string, _seq long, _op string, val string")
    feed = v.change_feed(log, ["id"], 1, 2)
    assert "SortAggregate" not in plan(feed) and "ObjectHashAggregate" not in plan(feed)
    assert sorted(tuple(r) for r in feed.collect()) == [("a", "x", "update_preimage"), ("a", "y", "update_postimage"), ("b", "z", "insert")]


def test_no_cartesian_products(spark):
    from conftest import ROOT

    names = ["join_range_price", "join_point_in_time", "usage_cost", "effective_policies", "gold_daily_revenue", "change_feed", "join_salted"]
    for name in names:
        text = plan(QUERIES[name](spark, ROOT))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
