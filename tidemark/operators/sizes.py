"""Size checks that decide whether a side may be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 32 * 1024 * 1024

_FLAT = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, _FLAT):
        return F.lit(8).cast("long")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)).cast("long") + 16
    return F.octet_length(F.to_json(F.struct(field.name))).cast("long") + 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take, from one aggregate over them."""
    row = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(16).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within ``limit``.

    Above the limit the frame comes back unmarked and the join shuffles, so
    the answer never depends on the size.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
