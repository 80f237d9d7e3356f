"""Filters, joins, set operations and top-k in the forms the queries share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .sizes import BROADCAST_BYTES, broadcast_if_small, measured_bytes


def any_ilike(column: str, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).ilike(p) for p in patterns])


def within_last(df: DataFrame, column: str, as_of: str | None = None, days: int = 0, minutes: int = 0) -> DataFrame:
    """Rows of the last ``days`` and ``minutes`` before ``as_of`` (now if not given).

    The bounds are constants of the column's own type, so they reach the scan.
    """
    kind = df.schema[column].dataType
    end = (F.lit(as_of).cast(kind)) if as_of else F.current_timestamp().cast(kind)
    start = end - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes))
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def in_set(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def absent_from(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys`` (NOT EXISTS: NULL keys are kept)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def not_in_set(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """SQL ``NOT IN``: a NULL in the list leaves no row, and a NULL key matches only an empty list.

    Whether the list is empty or holds a NULL is found in one aggregate; the
    rest is a plain anti join, which shuffles instead of broadcasting the list.
    """
    facts = keys.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("present")).first()
    if facts["n"] == 0:
        return df
    if facts["present"] < facts["n"]:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).isNotNull()).join(keys.select(column).distinct(), [column], "left_anti")


def param_query(spark: SparkSession, text: str, values: Mapping[str, object], **frames: DataFrame) -> DataFrame:
    """SQL with typed named parameters (``:name``) over DataFrames (``{name}``)."""
    return spark.sql(text, args=dict(values), **frames)


def join_broadcast(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Ship ``dim`` to every task when its measured size allows, otherwise shuffle both sides."""
    return fact.join(broadcast_if_small(dim), on, how)


def join_unequal(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join on a condition without an equality; ``right`` must be small, as every row of it meets every row of ``left``."""
    size = measured_bytes(right)
    if size > limit:
        raise ValueError(f"the right side takes {size} bytes; a join without an equality is limited to {limit}")
    return left.join(F.broadcast(right), condition, how)


_STRATEGIES = ("broadcast", "merge", "shuffle_hash")


def join_hinted(left: DataFrame, right: DataFrame, on, how: str, strategy: str) -> DataFrame:
    """Join with a named strategy; ``broadcast`` still needs the right side to pass the size check."""
    if strategy not in _STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}")
    if strategy == "broadcast":
        return join_broadcast(left, right, on, how)
    return left.join(right.hint(strategy), on, how)


def join_range(
    fact: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, start: str, end: str, unit: str = "month",
    open_until: str | None = None, closed_end: bool = True,
) -> DataFrame:
    """Rows of ``fact`` with the period of the same key in force at time ``at``.

    Periods are cut into calendar units and both sides meet on ``(keys, unit)``,
    so a row is compared only with the periods touching its own unit and a hot
    key is spread over the units. Periods without an end stay in force: they are
    cut after the last time in ``fact``, found in one aggregate, unless
    ``open_until`` names the instant. Cut periods that are measured to be small
    go to the rows; larger ones meet them in a shuffle.
    """
    if open_until is None:
        last = fact.agg(F.date_add(F.max(F.col(at)).cast("date"), 1).cast("string").alias("m")).first()["m"]
        open_until = last or "1970-01-01"
    bound = F.coalesce(F.col(end), F.lit(open_until).cast(periods.schema[end].dataType))
    day = {"day": "1 day", "month": "1 month", "year": "1 year"}[unit]
    units = F.sequence(
        F.date_trunc(unit, F.col(start)).cast("date"), F.date_trunc(unit, bound).cast("date"), F.expr(f"INTERVAL {day}")
    )
    cut = periods.withColumn(end, bound).filter(F.col(start) <= F.col(end)).withColumn("_unit", F.explode(units))
    located = fact.withColumn("_unit", F.date_trunc(unit, F.col(at)).cast("date"))
    joined = located.join(broadcast_if_small(cut), [*keys, "_unit"])
    upper = F.col(at) <= F.col(end) if closed_end else F.col(at) < F.col(end)
    return joined.filter((F.col(at) >= F.col(start)) & upper).drop("_unit")


def join_point_in_time(
    fact: DataFrame, history: DataFrame, keys: Sequence[str], at: str, start: str = "__START_AT", end: str = "__END_AT",
    unit: str = "month", open_until: str | None = None,
) -> DataFrame:
    """Rows of ``fact`` with the dimension version valid then: start <= at < end, no end = still valid.

    Open versions are cut as in ``join_range``.
    """
    return join_range(fact, history, keys, at, start, end, unit, open_until, closed_end=False)


def combine(left: DataFrame, right: DataFrame, mode: str, keep_copies: bool = False) -> DataFrame:
    """Stack or compare two inputs: union, union_by_name, intersect or except."""
    if mode == "union":
        return left.unionAll(right)
    if mode == "union_by_name":
        return left.unionByName(right, allowMissingColumns=True)
    if mode == "intersect":
        return left.intersectAll(right) if keep_copies else left.intersect(right)
    if mode == "except":
        return left.exceptAll(right) if keep_copies else left.subtract(right)
    raise ValueError(f"unknown mode {mode!r}")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
