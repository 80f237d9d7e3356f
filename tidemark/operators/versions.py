"""Versioned tables kept as an append-only change log.

A log row holds the key columns, ``_seq`` (commit number), optionally ``_ts``
(commit time), ``_op`` (``I``, ``U`` or ``D``) and the other columns after the
change. A key has at most one row per commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import latest

META = ("_seq", "_ts", "_op")


class UnknownVersion(ValueError):
    pass


def payload(log: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in log.columns if c not in META and c not in keys]


def _bounds(log: DataFrame):
    return log.agg(F.min("_seq").alias("lo"), F.max("_seq").alias("hi")).first()


def newest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest log row per key, tombstones included."""
    return latest(log, keys, [F.desc("_seq")])


def as_of(
    log: DataFrame, keys: Sequence[str], version: int | None = None, ts: str | None = None, kept_from: int | None = None,
    check: bool = True,
) -> DataFrame:
    """The table at a commit number or at a commit time.

    ``kept_from`` is the oldest version that is still complete after old log
    rows were expired. An unknown or expired version raises.
    """
    if (version is None) == (ts is None):
        raise ValueError("give a version or a timestamp")
    if ts is not None:
        instant = F.lit(ts).cast(log.schema["_ts"].dataType)
        seen = log.filter(F.col("_ts") <= instant)
        version = seen.agg(F.max("_seq").alias("v")).first()["v"]
        if version is None:
            raise UnknownVersion(f"no commit at or before {ts}")
        check = False
    if kept_from is not None and version < kept_from:
        raise UnknownVersion(f"version {version} is older than the retained history ({kept_from})")
    if check:
        known = _bounds(log)
        if known["lo"] is None or not known["lo"] <= version <= known["hi"]:
            raise UnknownVersion(f"version {version} is not in the log")
    past = log.filter(F.col("_seq") <= version)
    return newest_rows(past, keys).filter(F.col("_op") != "D").drop(*META)


def history(log: DataFrame) -> DataFrame:
    """One row per commit: time, operation and the number of rows inserted, updated and deleted.

    A commit of one kind of change is named after it, one of several is a merge.
    """
    when = F.max("_ts").alias("ts") if "_ts" in log.columns else F.lit(None).cast("timestamp").alias("ts")
    kinds = F.array_sort(F.collect_set("_op"))  # at most three per commit
    named = F.when(F.size(kinds) > 1, "MERGE")
    for op, name in (("I", "WRITE"), ("U", "UPDATE"), ("D", "DELETE")):
        named = named.when(F.element_at(kinds, 1) == op, name)
    return log.groupBy(F.col("_seq").alias("version")).agg(
        when,
        named.alias("operation"),
        F.count_if(F.col("_op") == "I").alias("n_inserted"),
        F.count_if(F.col("_op") == "U").alias("n_updated"),
        F.count_if(F.col("_op") == "D").alias("n_deleted"),
    )


def _differs(columns: Sequence[str], a: str, b: str) -> Column:
    if not columns:
        return F.lit(False)
    return reduce(lambda x, y: x | y, [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def compare(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer comparison of two snapshots: keys, structs ``_old`` and ``_new``, and ``_op`` of each change."""
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(F.lit(True).alias("_is"), *rest).alias("_old"))
    b = new.select(*keys, F.struct(F.lit(True).alias("_is"), *rest).alias("_new"))
    both = a.join(b, keys, "full")
    op = (
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_new").isNull(), "D")
        .when(_differs(rest, "_old", "_new"), "U")
    )
    return both.withColumn("_op", op).filter(F.col("_op").isNotNull())


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows that turn ``old`` into ``new``; a missing key is a delete."""
    rest = [c for c in new.columns if c not in keys]
    changed = compare(old, new, keys)
    values = [F.when(F.col("_op") != "D", F.col(f"_new.{c}")).alias(c) for c in rest]
    return changed.select(*keys, "_op", *values)


def commit(log: DataFrame, changes: DataFrame, version: int, ts: str | None = None) -> DataFrame:
    """The log with one more commit appended."""
    rows = changes.withColumn("_seq", F.lit(version).cast(log.schema["_seq"].dataType))
    if "_ts" in log.columns:
        rows = rows.withColumn("_ts", F.lit(ts).cast(log.schema["_ts"].dataType))
    return log.unionByName(rows.select(*log.columns))


def restore(log: DataFrame, keys: Sequence[str], version: int, ts: str | None = None) -> DataFrame:
    """The log with a new commit that makes the table equal to an old version."""
    head = _bounds(log)["hi"]
    changes = difference(as_of(log, keys, head, check=False), as_of(log, keys, version), keys)
    return commit(log, changes, head + 1, ts)


def recover_deleted(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Rows of an old version whose key is missing now."""
    now = newest_rows(log, keys).filter(F.col("_op") != "D").select(*keys)
    return as_of(log, keys, version).join(now, list(keys), "left_anti")


def change_feed(log: DataFrame, keys: Sequence[str], from_version: int, to_version: int) -> DataFrame:
    """Net changes after ``from_version`` up to ``to_version``; an update gives its row before and after.

    ``from_version`` may lie before the first commit, which then counts as an empty table.
    A commit holds a key once.
    """
    keys = list(keys)
    rest = payload(log, keys)
    # The aggregate over the log carries two numbers a key; only rows of keys that changed are fetched afterwards.
    places = (
        log.filter(F.col("_seq") <= to_version)
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("_seq") <= from_version, F.col("_seq"))).alias("_from"), F.max("_seq").alias("_to"))
        .filter(F.col("_to") > from_version)
    )

    def image(name: str, at: str) -> DataFrame:
        old = F.col("_seq") <= from_version
        rows = log.filter(old if at == "_from" else ~old & (F.col("_seq") <= to_version))
        return rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_seq").alias("_at"), F.struct("_op", *rest).alias(name))

    def fetch(left: DataFrame, name: str, at: str, how: str) -> DataFrame:
        match = F.col(at) == F.col("_at")
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return left.join(image(name, at), match, how).drop("_at", *[f"_k_{k}" for k in keys])

    both = fetch(fetch(places, "_new", "_to", "inner"), "_old", "_from", "left")
    had, has = (F.col(c).isNotNull() & (F.col(f"{c}._op") != "D") for c in ("_old", "_new"))
    op = F.when(has & ~had, "I").when(had & ~has, "D").when(had & has & _differs(rest, "_old", "_new"), "U")
    images_ = [F.struct(*[F.col(f"{c}.{x}").alias(x) for x in rest]) for c in ("_old", "_new")]
    changed = both.withColumn("_op", op).filter(F.col("_op").isNotNull())
    before = F.struct(
        F.when(F.col("_op") == "D", "delete").otherwise("update_preimage").alias("_change_type"), images_[0].alias("r")
    )
    after = F.struct(
        F.when(F.col("_op") == "I", "insert").otherwise("update_postimage").alias("_change_type"), images_[1].alias("r")
    )
    images = F.when(F.col("_op") == "I", F.array(after)).when(F.col("_op") == "D", F.array(before)).otherwise(
        F.array(before, after)
    )
    rows = changed.select(*keys, F.explode(images).alias("i"))
    return rows.select(*keys, *[F.col(f"i.r.{c}").alias(c) for c in rest], F.col("i._change_type").alias("_change_type"))


def change_feed_by_commit(log: DataFrame, keys: Sequence[str], from_version: int, to_version: int) -> DataFrame:
    """Changes of every commit in ``[from_version, to_version]``.

    ``_commit_version`` names the commit, and ``_commit_timestamp`` its time if the log has commit times.
    The row before a change is the adjacent older log row of the key.
    """
    from .ordered import neighbours

    keys = list(keys)
    rest = payload(log, keys)
    upto = log.filter(F.col("_seq") <= to_version)
    linked = neighbours(upto, keys, ["_seq"], ["_op", *rest]).filter(F.col("_seq") >= from_version)
    had = F.col("_prev").isNotNull() & (F.col("_prev._op") != "D")
    now = F.struct(*rest)
    old = F.struct(*[F.col(f"_prev.{c}").alias(c) for c in rest])
    def tagged(kind, r):
        return F.struct(F.lit(kind).alias("_change_type"), r.alias("r"))

    images = (
        F.when((F.col("_op") == "D") & had, F.array(tagged("delete", old)))
        .when(F.col("_op") == "D", F.array().cast(f"array<struct<_change_type:string,r:{_ddl(log, rest)}>>"))
        .when(had, F.array(tagged("update_preimage", old), tagged("update_postimage", now)))
        .otherwise(F.array(tagged("insert", now)))
    )
    commit = {"_commit_version": "_seq", **({"_commit_timestamp": "_ts"} if "_ts" in log.columns else {})}
    rows = linked.select(*keys, *[F.col(c).alias(name) for name, c in commit.items()], F.explode(images).alias("i"))
    return rows.select(
        *keys, *[F.col(f"i.r.{c}").alias(c) for c in rest], F.col("i._change_type").alias("_change_type"), *commit
    )


def _ddl(log: DataFrame, columns: Sequence[str]) -> str:
    return log.select(F.struct(*columns).alias("r")).schema["r"].dataType.simpleString()


def snapshot_copy(source: DataFrame, copied: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows to append to a copy: all of them the first time, later only those it lacks."""
    if copied is None:
        return source
    return source.join(copied.select(*keys).distinct(), list(keys), "left_anti").select(*source.columns)


def expire_history(log: DataFrame, keys: Sequence[str], horizon: int, head: int, min_keep: int = 1, force: bool = False):
    """Split the log at a horizon into ``(kept, dropped)``; ``dropped`` is the dry-run listing.

    Kept are all rows after the horizon and, per key, the newest row at or
    before it unless that is a delete, so every version from the horizon on
    can still be read.
    """
    if not force and head - horizon < min_keep:
        raise ValueError(f"horizon {horizon} keeps fewer than {min_keep} versions before {head}")
    old = log.filter(F.col("_seq") <= horizon)
    base = newest_rows(old, keys).filter(F.col("_op") != "D")
    kept = log.filter(F.col("_seq") > horizon).unionByName(base)
    ids = [*keys, "_seq"]
    dropped = old.join(base.select(*ids), ids, "left_anti").select(*log.columns)
    return kept, dropped
