"""Raw, cleaned and aggregated layers as plain functions of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .quality import all_pass


def bronze(df: DataFrame) -> DataFrame:
    """Rows as they came, with source file and load time."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_load_time"))


def silver(raw: DataFrame, rules: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """Rows that pass every rule, one per key."""
    return raw.filter(all_pass(rules)).dropDuplicates(list(keys))


def daily_revenue(
    lines: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Revenue and order lines by region and order day.

    Lines are summed per order first, so the wide fact meets the dimensions as
    one row per order.
    """
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.count(F.lit(1)).alias("n")
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = customer.select("c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    placed = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    joined = per_order.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("r_name").alias("region"), F.to_date("o_orderdate").alias("day")).agg(
        F.round(F.sum("revenue"), 4).alias("revenue"), F.sum("n").alias("n_lines")
    )


def rejoin_dimension(facts: DataFrame, dimension: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """Facts with the dimension as it is now; recomputed on every refresh."""
    return facts.join(dimension, on, "left")
