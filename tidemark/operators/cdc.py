"""Change-data-capture feeds applied to current and historised dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .merge import Delete, Insert, Update, merge
from .ordered import latest, neighbours, plan_slices
from .versions import difference


def _flag(condition: str | None) -> Column:
    return F.lit(False) if condition is None else F.coalesce(F.expr(condition), F.lit(False))


def scd1_state(
    feed: DataFrame,
    keys: Sequence[str],
    sequence: str,
    deletes: str | None = None,
    truncates: str | None = None,
    except_cols: Sequence[str] = (),
    state: DataFrame | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Stored form of a current-state dimension: newest row per key with ``__seq`` and ``__deleted``.

    The highest sequence wins whatever the arrival order. Deletes stay as
    tombstones, and the newest truncate stays as a row of its own (NULL keys),
    so rows arriving late cannot bring old data back.
    """
    keys = list(keys)
    columns = [c for c in feed.columns if c not in (sequence, *except_cols)]
    tied = [F.desc(c) for c in tie]
    rows = feed.select(
        *columns, F.col(sequence).alias("__seq"), _flag(deletes).alias("__deleted"),
        _flag(truncates).alias("__truncate"), F.struct(*[F.col(c) for c in tie] or [F.lit(0)]).alias("__tie"),
    )
    if state is not None:
        rows = rows.unionByName(state)
    newest_truncate = None
    if truncates is not None or state is not None:
        newest_truncate = rows.filter("__truncate").agg(F.max("__seq").alias("s")).first()["s"]
    plain = rows.filter("NOT __truncate")
    if newest_truncate is not None:
        plain = plain.filter(F.col("__seq") > F.lit(newest_truncate).cast(rows.schema["__seq"].dataType))
    newest = latest(plain, keys, [F.desc("__seq"), F.desc("__tie")])
    if newest_truncate is None:
        return newest
    marker = latest(rows.filter("__truncate"), ["__truncate"], [F.desc("__seq"), F.desc("__tie")])
    blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns]
    return newest.unionByName(marker.select(*blank, "__seq", "__deleted", "__truncate", "__tie"))


def scd1(feed: DataFrame, keys: Sequence[str], sequence: str, **options) -> DataFrame:
    """Current rows of a dimension: the stored form without tombstones and bookkeeping columns."""
    state = scd1_state(feed, keys, sequence, **options)
    return state.filter("NOT __deleted AND NOT __truncate").drop("__seq", "__deleted", "__truncate", "__tie")


def scd2(
    feed: DataFrame,
    keys: Sequence[str],
    sequence: str,
    deletes: str | None = None,
    track_except: Sequence[str] = (),
    except_cols: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """History of a dimension: one row per run of equal tracked columns.

    ``__START_AT`` is the sequence of the run's first row, ``__END_AT`` that of
    the next run or delete (NULL while open). Columns in ``track_except`` hold
    their last value within the run. A delete only closes; a re-insert opens a
    new run. Rows with equal sequence are settled by ``tie``, highest first.
    """
    keys = list(keys)
    dropped = {sequence, *except_cols}
    columns = [c for c in feed.columns if c not in dropped and c not in keys]
    tracked = [c for c in columns if c not in track_except]
    rows = feed.select(
        *keys, *columns, F.col(sequence).alias("__START_AT"), _flag(deletes).alias("_del"),
        F.struct(*[F.col(c) for c in tracked] or [F.lit(0)]).alias("_sig"),
        F.struct(*[F.col(c) for c in tie] or [F.lit(0)]).alias("_tie"),
    )
    slicing = plan_slices(rows, keys, "__START_AT")
    # One shuffle serves the tie-break and both passes over the timeline.
    linked = neighbours(
        rows, keys, ["__START_AT"], ["_sig", "_del", "__START_AT"], slicing=slicing, tie=["_tie"], keep_slice=True
    ).filter("NOT _del")

    def joins(side: str) -> Column:
        same = F.col(f"{side}._sig").eqNullSafe(F.col("_sig"))
        return F.col(side).isNotNull() & ~F.col(f"{side}._del") & same

    ends = (
        linked.withColumn("_starts", ~joins("_prev"))
        .withColumn("_ends", ~joins("_next"))
        .withColumn("__END_AT", F.col("_next.__START_AT"))
        .drop("_prev", "_next", "_del", "_sig", "_tie")
        .filter("_starts OR _ends")
    )
    if not track_except:
        pairs = neighbours(ends, keys, ["__START_AT"], ["__END_AT"], slicing=slicing).filter("_starts")
        end = F.when(F.col("_ends"), F.col("__END_AT")).otherwise(F.col("_next.__END_AT"))
        return pairs.select(*keys, *columns, "__START_AT", end.alias("__END_AT"))
    carry = ["__END_AT", *track_except]
    pairs = neighbours(ends, keys, ["__START_AT"], carry, slicing=slicing).filter("_starts")

    def last(c: str) -> Column:
        return F.when(F.col("_ends"), F.col(c)).otherwise(F.col(f"_next.{c}")).alias(c)

    values = [last(c) if c in track_except else F.col(c) for c in columns]
    return pairs.select(*keys, *values, "__START_AT", last("__END_AT"))


def scd2_refresh(
    dimension: DataFrame, retained: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str, **options
) -> DataFrame:
    """Dimension after a new batch: intervals are rebuilt for the touched keys only.

    ``retained`` holds the change rows seen so far; late rows therefore land
    in the right place.
    """
    keys = list(keys)
    touched = batch.select(*keys).distinct()
    feed = retained.join(touched, keys, "left_semi").unionByName(batch)
    rebuilt = scd2(feed, keys, sequence, **options)
    untouched = dimension.join(touched, keys, "left_anti").select(*dimension.columns)
    return untouched.unionByName(rebuilt)


def from_snapshots(previous: DataFrame, current: DataFrame, keys: Sequence[str], version) -> DataFrame:
    """Change rows (``I``, ``U``, ``D`` in ``_op``) between two full snapshots, stamped with ``_seq``."""
    return difference(previous, current, keys).withColumn("_seq", F.lit(version))


def scd2_merge(
    dimension: DataFrame, updates: DataFrame, keys: Sequence[str], compare: Sequence[str], effective: str,
    start: str = "start_date", end: str = "end_date", current: str = "is_current",
) -> DataFrame:
    """Close the current row of changed keys and open a new one, by two merges.

    Unchanged keys keep their row; unknown keys get a first row.
    """
    keys = list(keys)
    changed = " OR ".join(f"NOT (t.`{c}` <=> s.`{c}`)" for c in compare)
    closed = merge(
        dimension, updates, keys,
        matched=[Update({end: f"s.`{effective}`", current: "false"}, f"t.`{current}` AND ({changed})")],
        not_matched=[],
    )
    # A key whose current row is gone was closed just now or never existed.
    open_keys = closed.filter(F.col(current)).select(*keys)
    opening = updates.join(open_keys, keys, "left_anti")
    new_rows = opening.select(
        *[
            F.col(effective).cast(f.dataType).alias(start) if f.name == start
            else F.lit(None).cast(f.dataType).alias(end) if f.name == end
            else F.lit(True).alias(current) if f.name == current
            else F.col(f.name)
            for f in dimension.schema.fields
        ]
    )
    return closed.unionByName(new_rows)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], evolve: bool = False) -> DataFrame:
    """Target after change rows with ``_op``: deletes remove, the rest upsert."""
    values = [c for c in changes.columns if c not in ("_op", "_seq", "_ts")]
    setting = {c: f"s.`{c}`" for c in values}
    return merge(
        target, changes, keys,
        matched=[Delete("s._op = 'D'"), Update(setting)],
        not_matched=[Insert(setting, "s._op <> 'D'")],
        evolve=evolve,
    )
