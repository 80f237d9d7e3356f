"""Data-quality rules, write-time constraints and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ..session import materialize

WARN, DROP, FAIL = "warn", "drop", "fail"


class ExpectationFailed(ValueError):
    pass


class ConstraintViolation(ValueError):
    pass


class SchemaMismatch(ValueError):
    pass


def passes(rule: str) -> Column:
    """TRUE only if the rule holds; a NULL result counts as a violation."""
    return F.coalesce(F.expr(rule), F.lit(False))


def all_pass(rules: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [passes(r) for r in rules.values()])


def metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule with the rows that pass and violate it, from a single scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(passes(r)).alias(f"_{i}") for i, r in enumerate(rules.values())]
    )
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("passed"), (F.col("_n") - F.col(f"_{i}")).alias("failed"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("m")).select("m.*")


def expect(df: DataFrame, rules: Mapping[str, str], action: str = WARN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(good, bad, metrics)``; good and bad together are always the input.

    ``warn`` lets violating rows through (bad is empty), ``drop`` moves them to
    bad, ``fail`` raises before anything can be written.
    """
    if not rules:
        raise ValueError("no rules given")
    ok = all_pass(rules)
    if action == WARN:
        return df, df.filter(F.lit(False)), metrics(df, rules)
    if action == DROP:
        return df.filter(ok), df.filter(~ok), metrics(df, rules)
    if action == FAIL:
        counted = metrics(df, rules)
        rows = counted.collect()  # one row per rule, from the only scan
        broken = [r["rule"] for r in rows if r["failed"]]
        if broken:
            raise ExpectationFailed(f"rules violated: {broken}", broken)
        return df, df.filter(F.lit(False)), df.sparkSession.createDataFrame(rows, counted.schema)
    raise ValueError(f"unknown action {action!r}")


def observed(df: DataFrame, rules: Mapping[str, str], name: str = "quality") -> tuple[DataFrame, Observation]:
    """Count violations in the very job that writes ``df``; read them from the observation afterwards."""
    seen = Observation(name)
    counts = [F.count_if(~passes(r)).alias(rule) for rule, r in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts), seen


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with the names of the rules they break."""
    broken = F.array_compact(F.array(*[F.when(~passes(r), F.lit(n)) for n, r in rules.items()]))
    tagged = df.withColumn("_broken", broken)
    return tagged.filter(F.size("_broken") == 0).drop("_broken"), tagged.filter(F.size("_broken") > 0)


def quality_trend(runs: DataFrame, factor: float = 2.0) -> DataFrame:
    """Violations per rule and run against the rule's previous run; ``spike`` = more than ``factor`` times as many.

    ``runs`` has one row per ``(run, rule, failed)``, so a rule's window holds
    as many rows as there were runs.
    """
    w = Window.partitionBy("rule").orderBy("run")
    before = F.lag("failed").over(w)
    return runs.withColumn("previous", before).withColumn(
        "spike", F.coalesce(F.col("failed") > factor * F.col("previous"), F.lit(False))
    )


def check_constraints(df: DataFrame, not_null: Sequence[str] = (), checks: Mapping[str, str] | None = None) -> DataFrame:
    """Return ``df`` if it satisfies the table's constraints, else raise. CHECK lets a NULL result pass."""
    rules = {f"{c} NOT NULL": F.col(c).isNotNull() for c in not_null}
    rules.update({n: F.coalesce(F.expr(r), F.lit(True)) for n, r in (checks or {}).items()})
    if not rules:
        return df
    ok = reduce(lambda a, b: a & b, rules.values())
    bad = df.filter(~ok)
    if not bad.isEmpty():
        counts = df.agg(*[F.count_if(~c).alias(n) for n, c in rules.items()]).first().asDict()
        raise ConstraintViolation(f"violations: { {k: v for k, v in counts.items() if v} }")
    return df


def constraint_report(df: DataFrame, not_null: Sequence[str] = (), checks: Mapping[str, str] | None = None) -> DataFrame:
    """One row per constraint with its number of violations."""
    rules = {f"{c} NOT NULL": f"`{c}` IS NOT NULL" for c in not_null}
    rules.update({n: f"coalesce({r}, true)" for n, r in (checks or {}).items()})
    return metrics(df, rules).select(F.col("rule").alias("constraint"), F.col("failed").alias("violations"))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the table's schema; unknown columns and incompatible types are rejected, missing ones become NULL."""
    known = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise SchemaMismatch(f"unknown columns {unknown}")
    out = []
    for name, kind in known.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        have = df.schema[name].dataType
        if have != kind and not _fits(have, kind):
            raise SchemaMismatch(f"column {name} is {have.simpleString()}, the table has {kind.simpleString()}")
        out.append(F.col(name).cast(kind).alias(name))
    return df.select(*out)


_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _fits(have: T.DataType, want: T.DataType) -> bool:
    ranks = {k: i for i, k in enumerate(_ORDER)}
    a, b = ranks.get(type(have)), ranks.get(type(want))
    return a is not None and b is not None and a <= b


def merge_schema(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows whose extra columns join the table; older rows hold NULL there."""
    return table.unionByName(rows, allowMissingColumns=True)


def generated(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Derived columns by SQL expression; a value already supplied must agree."""
    for name, rule in columns.items():
        if name in df.columns and not df.filter(~F.col(name).eqNullSafe(F.expr(rule))).isEmpty():
            raise ConstraintViolation(f"supplied {name} differs from its expression")
        df = df.withColumn(name, F.expr(rule))
    return df


def surrogate_key(df: DataFrame, name: str, after: int = 0, materialized: bool = False) -> DataFrame:
    """Unique ascending ids after ``after``, without gaps and without a single-task window.

    Rows get their place inside their partition; partition offsets come from a
    table with one row per partition. The rows are written out first so both
    passes see the same partitions.
    """
    mid = "_mid"
    placed = df.withColumn(mid, F.monotonically_increasing_id())
    if not materialized:
        placed = materialize(placed, "surrogate")
    pid = F.shiftright(mid, 33)
    counts = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    row = F.col(mid).bitwiseAND((1 << 33) - 1)
    keyed = placed.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
    return keyed.withColumn(name, F.col("_offset") + row + after + 1).drop(mid, "_pid", "_offset")


def row_count_gate(df: DataFrame, at_least: int, accepted: str = "publish", refused: str = "quarantine") -> DataFrame:
    """One row: the count and where the rows should go."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.withColumn("decision", F.when(F.col("n_rows") >= at_least, accepted).otherwise(refused))


_COMPARE = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "=": "__eq__", "<>": "__ne__"}


def sql_alerts(rules: Sequence[tuple[str, DataFrame, str, float]]) -> DataFrame:
    """One row per rule ``(name, one-value frame, comparison, threshold)`` with whether it fired."""
    rows = []
    for name, value, op, threshold in rules:
        v = F.col(value.columns[0]).cast("double")
        fired = F.coalesce(getattr(v, _COMPARE[op])(F.lit(float(threshold))), F.lit(False))
        rows.append(
            value.select(F.lit(name).alias("alert"), v.alias("value"), F.lit(float(threshold)).alias("threshold"), fired.alias("fired"))
        )
    return reduce(DataFrame.unionAll, rows)
