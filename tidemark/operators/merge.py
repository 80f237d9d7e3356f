"""Keyed merges and slice rewrites as functions from DataFrames to a new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settled
from ..sources import swap


@dataclass(frozen=True)
class Update:
    """Set columns to SQL expressions over ``t`` and ``s``; no ``values`` = every source column."""

    values: Mapping[str, str] | None = None
    when: str | None = None


@dataclass(frozen=True)
class Delete:
    when: str | None = None


@dataclass(frozen=True)
class Insert:
    """Insert SQL expressions over ``s``; no ``values`` = every source column."""

    values: Mapping[str, str] | None = None
    when: str | None = None


class MultipleMatchError(ValueError):
    pass


class SliceViolation(ValueError):
    pass


def _holds(condition: str | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(F.expr(condition), F.lit(False))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _choice(clauses: Sequence) -> Column:
    """Number of the first clause that holds, or NULL."""
    picked = F.lit(None).cast("int")
    for i in reversed(range(len(clauses))):
        picked = F.when(_holds(clauses[i].when), F.lit(i)).otherwise(picked)
    return picked


def repeated_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of target rows that several source rows match, and how many do. Reads only the key columns."""
    keys = list(keys)
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows")).filter("source_rows > 1")
    return repeated.join(target.select(*keys).distinct(), keys, "left_semi")


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if several source rows match one target row."""
    some = repeated_matches(target, source, keys).limit(3).collect()
    if some:
        named = "; ".join(str(tuple(r)[: len(keys)]) for r in some)
        raise MultipleMatchError(f"several source rows match one target row on {list(keys)}, such as {named}")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    not_matched_by_source: Sequence[Update | Delete] = (),
    evolve: bool = False,
    within: str | None = None,
    guard: bool = True,
) -> DataFrame:
    """The table after a keyed merge.

    Clauses are tried in order and the first that holds wins; a row for which
    none holds stays as it is (target) or is ignored (source). NULL keys never
    match. ``within`` limits the merge to a slice of the target: other rows
    pass through untouched, and count as not matched.

    A left join keeps and changes target rows and an anti join finds new ones.
    Adaptive execution can split a hot key in both, which it cannot do in a
    full outer join; rows with NULL keys skip the joins altogether. The source is
    read by several of these steps, so one that could differ from read to read is
    stored first.
    """
    keys = list(keys)
    source = settled(source, "merge-source")
    extra = [f for f in source.schema.fields if f.name not in target.columns]
    if evolve:
        for field in extra:
            target = target.withColumn(field.name, F.lit(None).cast(field.dataType))
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    shared = [c for c in columns if c in source.columns]
    inside, outside = target, None
    if within is not None:
        holds = F.coalesce(F.expr(within), F.lit(False))
        inside, outside = target.filter(holds), target.filter(~holds)
    if guard:
        check_single_match(inside, source, keys)

    def apply(clauses, everything):
        """Columns of the row after the chosen clause; ``everything`` = the values of a clause without any."""
        out = []
        for c in columns:
            value = F.col(f"t.{c}")
            for i, clause in enumerate(clauses):
                if isinstance(clause, Delete):
                    continue
                settings = everything if clause.values is None else clause.values
                if c in settings:
                    value = F.when(F.col("_choice") == i, F.expr(settings[c]).cast(types[c])).otherwise(value)
            out.append(value.alias(c))
        return out

    def survivors(frame, clauses, everything):
        chosen = frame.withColumn("_choice", _choice(clauses))
        deletes = [i for i, c in enumerate(clauses) if isinstance(c, Delete)]
        if deletes:
            chosen = chosen.filter(~F.coalesce(F.col("_choice").isin(deletes), F.lit(False)))
        return chosen.select(*apply(clauses, everything))

    from_source = {c: f"s.`{c}`" for c in shared}
    same_key = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    usable = source.filter(~_any_null(keys)).withColumn("_present", F.lit(True))
    parts = []

    keyed = inside.filter(~_any_null(keys))
    unmatchable = inside.filter(_any_null(keys))
    both = keyed.alias("t").join(usable.alias("s"), same_key, "left")
    # One pass decides both kinds of target row: clauses of the kind that does not apply are switched off.
    present = "s._present IS NOT NULL"
    rules = [_limited(c, present) for c in matched] + [_limited(c, f"NOT ({present})") for c in not_matched_by_source]
    parts.append(survivors(both, rules, from_source))
    parts.append(survivors(unmatchable.alias("t"), list(not_matched_by_source), {}))
    if not_matched:
        fresh = usable.join(keyed.select(*keys).distinct(), keys, "left_anti")  # the same shuffle of the source serves both joins
        fresh = fresh.select(*source.columns).unionAll(source.filter(_any_null(keys)))
        chosen = fresh.alias("s").withColumn("_choice", _choice(not_matched)).filter(F.col("_choice").isNotNull())
        out = []
        for c in columns:
            value = F.lit(None).cast(types[c])
            for i, clause in enumerate(not_matched):
                settings = from_source if clause.values is None else clause.values
                if c in settings:
                    value = F.when(F.col("_choice") == i, F.expr(settings[c]).cast(types[c])).otherwise(value)
            out.append(value.alias(c))
        parts.append(chosen.select(*out))
    if outside is not None:
        parts.append(outside)
    return reduce(DataFrame.unionAll, parts)


def _limited(clause, extra: str):
    when = extra if clause.when is None else f"({extra}) AND ({clause.when})"
    return type(clause)(clause.values, when) if not isinstance(clause, Delete) else Delete(when)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], evolve: bool = False, guard: bool = True) -> DataFrame:
    """Matched rows take every source column, unmatched source rows are inserted."""
    return merge(target, source, keys, [Update()], [Insert()], evolve=evolve, guard=guard)


def update_where(df: DataFrame, condition: Column | str, values: Mapping[str, str | Column]) -> DataFrame:
    """Rows for which the condition is TRUE take the new values; NULL counts as no."""
    holds = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if field.name in values:
            v = values[field.name]
            new = (F.expr(v) if isinstance(v, str) else v).cast(field.dataType)
            col = F.when(holds, new).otherwise(col)
        out.append(col.alias(field.name))
    return df.select(*out)


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is not TRUE; a NULL result keeps the row."""
    holds = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(holds, F.lit(False)))


def delete_in(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Delete rows whose key is in a subquery."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti").select(*df.columns)


def replace_where(target: DataFrame, rows: DataFrame, condition: str) -> DataFrame:
    """Replace the slice matching ``condition``; raise if a new row lies outside it."""
    holds = F.coalesce(F.expr(condition), F.lit(False))
    if not rows.filter(~holds).isEmpty():
        raise SliceViolation(f"new rows violate {condition!r}")
    return target.filter(~holds).unionByName(rows.select(*target.columns))


def staged_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path`` by rows that may depend on it.

    The new files are staged inside the table and exchanged for the old ones
    afterwards, so ``path`` is never read and overwritten by one job and a
    crash leaves either the old table or an exchange the next job finishes.
    """
    spark = df.sparkSession
    # An exchange left half done is finished first, or its old rows would come back later.
    with swap.owned(spark, path):
        old = swap.data_files(spark, path)
        stage = swap.staging(path)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(stage)
        swap.exchange(spark, path, stage, old)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], where: str | None = None) -> None:
    """Replace only the directories present in ``df``."""
    if where is not None:
        raise ValueError("dynamic partition overwrite and a replacement predicate exclude each other")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def truncate(df_path: str, schema: T.StructType, spark) -> None:
    """Empty the table at a path and keep its columns; staged like any other rewrite."""
    staged_overwrite(spark.createDataFrame([], schema), df_path)
