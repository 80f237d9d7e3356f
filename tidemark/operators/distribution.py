"""Control over how rows are spread over partitions."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .skew import hot_shares, n_pieces, pieces, row_salt


def repartition_n(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def repartition_key(
    df: DataFrame, keys: Sequence[str], n: int, share: float | None = None, salts: int | None = None
) -> DataFrame:
    """Hash partitioning by key.

    With ``share``, keys above that share of the rows are spread over ``salts``
    or, without it, over as many as their share of the rows asks for.
    """
    cols = [F.col(k) for k in keys]
    hot = hot_shares(df, keys, min(share, 0.5 / n)) if share else {}
    if not hot:
        return df.repartition(n, *cols)
    salt = row_salt(df, n_pieces(keys, dict.fromkeys(hot, salts) if salts else pieces(df, hot)))
    return df.withColumn("_salt", salt).repartition(n, *cols, F.col("_salt")).drop("_salt")


def coalesce_n(df: DataFrame, n: int) -> DataFrame:
    return df.coalesce(n)


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """Even output partitions; adaptive execution splits large ones and merges small ones."""
    return df.hint("rebalance", *keys)


def partition_profile(df: DataFrame) -> DataFrame:
    """One row: number of non-empty partitions and the spread of their row counts."""
    per = df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_rows"),
        F.expr("percentile(n, 0.5)").alias("median_rows"),
    )


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a result for the body of the ``with`` block and release it after."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
