"""Synthetic facts and literal tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def gen_range(
    spark: SparkSession, rows: int, moduli: Mapping[str, int], measures: Sequence[str] = (), seed: int = 7
) -> DataFrame:
    """``id`` from 0, one modulo key per entry of ``moduli``, seeded random measures in [0, 1)."""
    df = spark.range(rows)
    keys = [(F.col("id") % n).cast("int").alias(name) for name, n in moduli.items()]
    return df.select("id", *keys, *[F.rand(seed + i).alias(m) for i, m in enumerate(measures)])


def skewed_key(id_col: str | Column, hot_share: float, others: int) -> Column:
    """Key 0 for about ``hot_share`` of the ids, keys 1..others for the rest; the same id always gets the same key."""
    spread = F.pmod(F.hash(id_col), F.lit(1_000_000))
    return F.when(spread < int(hot_share * 1_000_000), F.lit(0)).otherwise(
        F.pmod(F.hash(id_col, F.lit(1)), F.lit(others)) + 1
    )


def skewed_key_modulo(id_col: str | Column, hot_per_10: int, others: int) -> Column:
    """Like ``skewed_key`` but from plain modulo arithmetic, so any SQL engine can state it."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.when(i % 10 < hot_per_10, F.lit(0).cast("long")).otherwise(i % others + 1)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small literal table."""
    return spark.createDataFrame(list(rows), schema)
