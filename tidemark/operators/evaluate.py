"""Deterministic scorers for evaluation records, traces and version comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def matches(column: str | Column, pattern: str) -> Column:
    """1 if the text matches the pattern, 0 if not (NULL counts as no match)."""
    return F.coalesce(F.rlike(column, F.lit(pattern)), F.lit(False)).cast("double")


def exact_match(actual: str | Column, expected: str | Column) -> Column:
    a = F.col(actual) if isinstance(actual, str) else actual
    e = F.col(expected) if isinstance(expected, str) else expected
    return F.coalesce(F.trim(a) == F.trim(e), F.lit(False)).cast("double")


def within(column: str | Column, limit: float) -> Column:
    """1 if a measured value, such as a latency, is within the limit."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c <= limit, F.lit(False)).cast("double")


def score(df: DataFrame, keys: Sequence[str], scorers: Mapping[str, Column]) -> DataFrame:
    """Long format: one row per record and scorer."""
    wide = df.select(*keys, *[c.alias(n) for n, c in scorers.items()])
    return wide.unpivot(list(keys), list(scorers), "scorer", "value")


def summarise(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*by, "scorer").agg(
        F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def sampled(df: DataFrame, keys: Sequence[str], per_mille: int) -> DataFrame:
    """A repeatable share of the records, chosen by a hash of their key."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    number = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
    return df.filter(number % 1000 < per_mille)


def span_scores(traces: DataFrame, key: str, spans: str, kind: str, value: Column, name: str) -> DataFrame:
    """Score of the spans of one kind in every trace: number, sum and largest value."""
    flat = traces.select(key, F.explode(spans).alias("span")).filter(F.col("span.kind") == kind)
    return flat.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{name}_spans"), F.round(F.sum(value), 6).alias(f"{name}_total"), F.max(value).alias(f"{name}_max")
    )


def compare_versions(scores: DataFrame, version: str, baseline, candidate, tolerance: float = 0.0) -> DataFrame:
    """Mean per scorer in two versions, their difference, and whether the candidate is worse by more than the tolerance."""
    means = (
        scores.filter(F.col(version).isin([baseline, candidate]))
        .groupBy("scorer")
        .agg(
            F.round(F.avg(F.when(F.col(version) == baseline, F.col("value"))), 6).alias("baseline"),
            F.round(F.avg(F.when(F.col(version) == candidate, F.col("value"))), 6).alias("candidate"),
        )
    )
    return means.withColumn("delta", F.round(F.col("candidate") - F.col("baseline"), 6)).withColumn(
        "regressed", F.col("candidate") < F.col("baseline") - tolerance
    )
