"""Ordered per-key operators that never sort a whole hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .skew import SHARE, hot_shares, key_hash, pieces


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key in the given order.

    The rank filter becomes a group limit that runs before the shuffle, so
    each task sends at most ``n`` rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def position(df: DataFrame, column: str) -> Column:
    """A number that never decreases along the order of ``column``; the column itself where it has no such number."""
    kind, col = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{column}`)").cast("double")
    return col


def _place(df: DataFrame, order: Sequence[str]) -> Column:
    return position(df, order[0]) if len(order) == 1 else F.struct(*order)


@dataclass(frozen=True)
class Slicing:
    """Hot keys of a frame, by hash, each with the points at which its timeline is cut.

    Several ``order`` columns are cut together, as structs.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: dict[int, list]

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with its slice number: 0 for every key that is not hot."""
        if not self.cuts:
            return df.withColumn(name, F.lit(0))
        value = _place(df, self.order)
        kind = df.select(value).schema[0].dataType
        # One row per hot key; all of them together have a few cuts per shuffle task.
        schema = T.StructType().add("_h", T.LongType()).add("_cuts", T.ArrayType(kind))
        table = df.sparkSession.createDataFrame(list(self.cuts.items()), schema)
        passed = F.size(F.filter("_cuts", lambda c: c <= value))
        number = F.when(F.col("_cuts").isNull() | value.isNull(), F.lit(0)).otherwise(passed)
        located = df.join(F.broadcast(table), key_hash(self.keys) == F.col("_h"), "left")
        return located.withColumn(name, number).drop("_h", "_cuts")


def _quantiles(at: DataFrame, counts: dict[int, int]) -> dict[int, list]:
    """Cuts of numbers ``_at`` per key: approximate quantiles, one aggregate for all keys with equally many slices."""
    by_size = {n: [h for h, m in counts.items() if m == n] for n in set(counts.values())}
    cuts = [
        F.percentile_approx(F.when(F.col("_h").isin(hs), F.col("_at")), [i / n for i in range(1, n)], max(1000, 10 * n)).alias(f"n{n}")
        for n, hs in by_size.items()
    ]
    return {r["_h"]: r[f"n{counts[r['_h']]}"] for r in at.groupBy("_h").agg(*cuts).collect()}


def _boundaries(at: DataFrame, counts: dict[int, int]) -> dict[int, list]:
    """Cuts of values ``_at`` of any type per key: where the ranges begin into which Spark sorts them."""
    ranged = at.filter("_at IS NOT NULL").repartitionByRange(sum(counts.values()), "_h", "_at")
    starts = ranged.select("_h", "_at", F.spark_partition_id().alias("_p")).groupBy("_h", "_p").agg(F.min("_at").alias("_at"))
    cuts: dict[int, list] = {}
    for r in starts.collect():
        cuts.setdefault(r["_h"], []).append(r["_at"])
    return cuts


def plan_slices(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], share: float = SHARE, slices: int | None = None) -> Slicing:
    """Find the hot keys and cut the timeline of each along ``order``.

    A key gets as many slices as its share of the rows asks for, or ``slices``.
    Numbers and times are cut at quantiles, other values where ranges of their
    full values begin. With several order columns the first one is cut, unless
    too few values of it hold a hot key's rows; then all are cut together. Any
    frame with these columns can use the result.
    """
    keys, order = tuple(keys), (order,) if isinstance(order, str) else tuple(order)
    hot = hot_shares(df, keys, share)
    if not hot:
        return Slicing(keys, order[:1], {})
    counts = dict.fromkeys(hot, slices) if slices else pieces(df, hot)

    def cut(columns: tuple[str, ...]) -> dict[int, list]:
        at = df.select(key_hash(keys).alias("_h"), _place(df, columns).alias("_at")).filter(F.col("_h").isin(list(hot)))
        find = _quantiles if isinstance(at.schema["_at"].dataType, T.DoubleType) else _boundaries
        found = find(at, counts)
        return {h: sorted(set(found.get(h) or [])) for h in hot}

    cuts = cut(order[:1])
    if len(order) > 1 and any(len(cuts[h]) < counts[h] / 2 for h in hot):
        return Slicing(keys, order, cut(order))
    return Slicing(keys, order[:1], cuts)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    share: float = SHARE,
    slices: int | None = None,
    slicing: Slicing | None = None,
    tie: Sequence[str] | None = None,
    keep_slice: bool = False,
) -> DataFrame:
    """Add ``_prev`` and ``_next``: structs of ``carry`` from the adjacent rows of a key.

    ``order`` must be unique per key, unless ``tie`` is given: then of rows
    equal in ``order`` only the one highest in ``tie`` stays; those of a hot key
    lose the others before the shuffle, however many there are. A hot key is cut
    into slices along its order columns; neighbours inside a slice come
    from a window over the slice, and neighbours across a cut from a small
    table with the first and last row of every slice. ``keep_slice`` leaves the
    ``_slice`` column in place, so a second call on the result reuses its
    partitioning and order.
    """
    keys, order, carry = list(keys), list(order), list(carry)
    slicing = slicing or plan_slices(df, keys, order, share, slices)
    hot = list(slicing.cuts)
    cut = df if not hot or "_slice" in df.columns else slicing.add(df, "_slice")
    by = [*keys, "_slice"] if hot else keys
    if tie is not None:
        ranked = Window.partitionBy(*by).orderBy(*order, *[F.desc(c) for c in tie])
        here = F.struct(*order)
        if hot:
            crowded = key_hash(keys).isin(hot)
            once = latest(cut.filter(crowded), [*by, *order], [F.desc(c) for c in tie])
            cut = cut.filter(~crowded).unionByName(once)
        cut = cut.withColumn("_same", F.lag(here).over(ranked).eqNullSafe(here)).filter("NOT _same").drop("_same")
    w = Window.partitionBy(*by).orderBy(*order)
    payload = F.struct(*carry)
    out = cut.withColumn("_prev", F.lag(payload).over(w)).withColumn("_next", F.lead(payload).over(w))
    if not hot:
        return out
    # One row per slice of a hot key: a few rows per shuffle task.
    by_key = Window.partitionBy(*keys).orderBy("_slice")
    edges = (
        cut.filter(key_hash(keys).isin(hot))
        .groupBy(*keys, "_slice")
        .agg(F.min_by(payload, F.struct(*order)).alias("_first"), F.max_by(payload, F.struct(*order)).alias("_last"))
        .withColumn("_before", F.lag("_last").over(by_key))
        .withColumn("_after", F.lead("_first").over(by_key))
        .select(*[F.col(k).alias(f"_e_{k}") for k in keys], F.col("_slice").alias("_e_slice"), "_before", "_after")
    )
    match = F.col("_slice") == F.col("_e_slice")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    joined = out.join(F.broadcast(edges), match, "left")
    linked = joined.withColumn("_prev", F.coalesce("_prev", "_before")).withColumn("_next", F.coalesce("_next", "_after"))
    extra = ["_e_slice", "_before", "_after", *[f"_e_{k}" for k in keys]]
    return linked.drop(*extra) if keep_slice else linked.drop(*extra, "_slice")
