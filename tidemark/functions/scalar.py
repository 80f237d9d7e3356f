"""Column functions that need more than one built-in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.sizes import broadcast_if_small


def digits_only(col: str | Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def star_local_part(col: str | Column) -> Column:
    """Stars for the part of an address before ``@``, one per character."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, "@", 2)
    starred = F.concat(F.repeat(F.lit("*"), F.length(parts[0])), F.lit("@"), parts[1])
    return F.when(F.size(parts) == 2, starred).otherwise(c)


def null_safe_scale(col: str | Column, factor: float) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0)) * factor


def lookup(
    df: DataFrame, column: str, names: Mapping[object, str] | DataFrame, out: str, default: str = "UNKNOWN"
) -> DataFrame:
    """Name for each code, ``default`` for a miss.

    ``names`` is a small mapping or a two-column frame ``(key, value)``; it is
    joined, and broadcast if its size allows, instead of called per row.
    """
    if isinstance(names, Mapping):
        kind = df.schema[column].dataType
        schema = T.StructType([T.StructField("_k", kind), T.StructField("_v", T.StringType())])
        names = df.sparkSession.createDataFrame(list(names.items()), schema)
    pairs = names.toDF("_k", "_v")
    joined = df.join(broadcast_if_small(pairs), F.col(column) == F.col("_k"), "left")
    return joined.withColumn(out, F.coalesce("_v", F.lit(default))).drop("_k", "_v")


def interpolate(x: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """Linear between two points, flat outside them."""
    inside = F.lit(float(y0)) + (x - x0) / (x1 - x0) * (y1 - y0)
    return F.when(x < x0, F.lit(float(y0))).when(x > x1, F.lit(float(y1))).otherwise(inside)


def date_dim(first: Column, last: Column) -> list[Column]:
    """Columns that turn one row into one row per day, with year and month."""
    return [F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day")]


def map_batches(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """Apply ``fn(pandas batch) -> pandas batch`` to Arrow batches of any DataFrame."""

    def run(batches):
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)
