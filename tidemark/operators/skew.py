"""Joins and aggregations that stay balanced when a few keys hold most rows."""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_UNHASHABLE = (T.MapType, T.VariantType)
_NARROW = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Highest share of the rows a key may hold without counting as hot, however few the shuffle tasks.
SHARE = 0.02
#: Lowest share a sketch is asked for, as every task's sketch grows with its inverse; lower ones are counted exactly.
SKETCH_SHARE = 1 / 2000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_shares(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> dict[int, float]:
    """Hashes of the hot keys, each with its share of the rows.

    Hot is a key with more than ``share`` of the rows, or with more than half
    of one shuffle task's part if that is less. One pass with a frequent-items
    sketch; its shuffle is one sketch per task. With many shuffle tasks the
    share is too low for a sketch: then the keys are counted by their hashes,
    16 bytes a key through a shuffle. At most ``1/share`` keys can qualify, so
    the list is bounded whatever the data. A false positive only salts a key
    that did not need it.
    """
    share = min(share, 0.5 / shuffle_tasks(df))
    if share < SKETCH_SHARE:
        return _counted_shares(df, keys, share)
    tracked = 1 << max(12, math.ceil(math.log2(8 / share)))
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", key_hash(keys), F.lit(int(1 / share) + 1), F.lit(tracked)).alias("top"),
    ).first()
    floor = share * row["n"]
    return {item["item"]: item["count"] / row["n"] for item in (row["top"] or []) if item["count"] > floor}


def _counted_shares(df: DataFrame, keys: Sequence[str], share: float) -> dict[int, float]:
    counts = df.groupBy(key_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return {r["h"]: r["n"] / total for r in counts.filter(F.col("n") > share * total).collect()}


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> list[int]:
    return sorted(hot_shares(df, keys, share))


def pieces(df: DataFrame, shares: Mapping[int, float]) -> dict[int, int]:
    """Into how many pieces each hot key goes: a power of two, at which a piece is at most half of a shuffle task's part."""
    tasks = shuffle_tasks(df)
    return {h: 1 << max(1, math.ceil(math.log2(2 * share * tasks))) for h, share in shares.items()}


def n_pieces(keys: Sequence[str], counts: Mapping[int, int]) -> Column:
    """Number of pieces of a row's key: 1 for a key that is not hot."""
    number = F.lit(1)
    for n in sorted(set(counts.values())):
        number = F.when(is_hot(keys, [h for h, m in counts.items() if m == n]), F.lit(n)).otherwise(number)
    return number


def is_hot(keys: Sequence[str], hot: Collection[int]) -> Column:
    return key_hash(keys).isin(list(hot)) if hot else F.lit(False)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of a row's content and its partition.

    It does not depend on row order, so a recomputed task assigns the same
    values, and copies of one row still spread over the partitions holding
    them. By default only a few narrow columns are hashed, so a salt does not
    make a scan read columns nobody asked for.
    """
    if columns is None:
        usable = [f for f in df.schema.fields if not isinstance(f.dataType, _UNHASHABLE)]
        narrow = [f.name for f in usable if isinstance(f.dataType, _NARROW)]
        columns = (narrow or [f.name for f in usable])[:3]
    return F.xxhash64(*columns, F.spark_partition_id())


def row_salt(df: DataFrame, salts: int | Column, columns: Sequence[str] | None = None) -> Column:
    return F.pmod(row_hash(df, columns), F.lit(salts)).cast("int")


def join_salted(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
    share: float = SHARE,
    hot: Mapping[int, float] | None = None,
) -> DataFrame:
    """Join in which only the hot keys of ``fact`` are salted.

    Rows of ``dim`` for those keys are repeated once per salt; all other rows
    keep salt 0, so both kinds go through one join on ``(keys, salt)``. Without
    ``salts`` a key gets as many as its share of the rows asks for.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting repeats dimension rows, so {how!r} would duplicate them")
    on = list(on)
    hot = hot_shares(fact, on, share) if hot is None else hot
    if not hot:
        return fact.join(dim, on, how)
    n = n_pieces(on, dict.fromkeys(hot, salts) if salts else pieces(fact, hot))
    left = fact.withColumn("_salt", row_salt(fact, n))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return left.join(right, on + ["_salt"], how).drop("_salt")


def join_salted_full(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 8
) -> DataFrame:
    """Join in which every fact row is salted and the whole dimension is repeated."""
    if how not in ("inner", "left"):
        raise ValueError(f"salting repeats dimension rows, so {how!r} would duplicate them")
    on = list(on)
    left = fact.withColumn("_salt", row_salt(fact, salts))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, on + ["_salt"], how).drop("_salt")


def agg_salted(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]], salts: int = 16
) -> DataFrame:
    """Two-stage aggregation: partials per ``(keys, salt)``, then per key.

    ``measures`` maps an output name to ``(function, column)``. Averages carry
    a sum and a count through both stages.
    """
    keys = list(keys)
    partial, final = [], []
    for name, (fn, col) in measures.items():
        if fn == "sum":
            partial.append(F.sum(col).alias(name))
            final.append(F.sum(name).alias(name))
        elif fn == "count":
            partial.append((F.count(F.lit(1)) if col == "*" else F.count(col)).alias(name))
            final.append(F.sum(name).alias(name))
        elif fn in ("min", "max"):
            stage = getattr(F, fn)
            partial.append(stage(col).alias(name))
            final.append(stage(name).alias(name))
        elif fn == "avg":
            partial += [F.sum(col).alias(f"_{name}_s"), F.count(col).alias(f"_{name}_c")]
            final.append((F.sum(f"_{name}_s") / F.nullif(F.sum(f"_{name}_c"), F.lit(0))).alias(name))
        else:
            raise ValueError(f"{fn} does not re-aggregate from per-salt results")
    needed = df.select(*dict.fromkeys([*keys, *[c for _, c in measures.values() if c != "*"]]))
    salted = needed.withColumn("_salt", row_salt(needed, salts))
    return salted.groupBy(*keys, "_salt").agg(*partial).groupBy(*keys).agg(*final)


def skew_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: spread of the per-key row counts and the largest key's share."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_rows"),
        F.expr("percentile(n, 0.5)").alias("median_rows"),
        F.expr("percentile(n, 0.75)").alias("p75_rows"),
    ).select(
        "*",
        F.round(F.col("max_rows") / F.col("median_rows"), 6).alias("max_over_median"),
        F.round(F.col("max_rows") / F.col("n_rows"), 6).alias("top_share"),
    )


def key_shares(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` keys with most rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), *keys).limit(n)


def join_bucketed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    tables: Sequence[str],
    paths: Sequence[str],
    buckets: int,
    share: float = SHARE,
) -> DataFrame:
    """Inner join through two bucketed tables, with the hot keys joined apart.

    A bucket is read by one task, so a hot key would make its bucket the whole
    job. Cold rows use the co-located tables without a shuffle; the few hot
    keys go through the salted join.
    """
    from ..sources.files import write_bucketed

    on = list(on)
    hot = hot_shares(left, on, min(share, 0.5 / buckets))
    cold = ~is_hot(on, hot)
    write_bucketed(left.filter(cold), tables[0], paths[0], buckets, on)
    write_bucketed(right.filter(cold), tables[1], paths[1], buckets, on)
    spark = left.sparkSession
    joined = spark.table(tables[0]).hint("merge").join(spark.table(tables[1]), on)
    if not hot:
        return joined
    apart = join_salted(left.filter(is_hot(on, hot)), right.filter(is_hot(on, hot)), on, hot=hot)
    return joined.unionByName(apart)
