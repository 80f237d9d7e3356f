"""Change-data-capture from a stream: current and historised dimensions kept up per micro-batch.

State lies in key buckets (``state.KeyedState``); a batch reads and writes the
buckets of its keys only, whatever has come before. Rows may arrive late by any
amount: the current dimension keeps tombstones of deleted keys, the historised one
the change rows of every key, from which the intervals of the batch's keys are
built anew.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from .jobs import for_each_batch
from .state import KeyedState


def apply_current(
    state: KeyedState, rows: DataFrame, batch: int, sequence: str, deletes: str | None = None, truncates: str | None = None, **options
) -> dict:
    """One batch into a current-state dimension; options as in ``cdc.scd1_state``."""

    def change(tables: Mapping[str, DataFrame | None], new: DataFrame) -> dict[str, DataFrame]:
        after = cdc.scd1_state(new, state.keys, sequence, deletes, truncates, state=tables["current"], **options)
        return {"current": after}

    shared = None if truncates is None else F.col("__truncate")
    return state.apply(rows, batch, change, ["current"], shared)


def current(state: KeyedState) -> DataFrame:
    """Current rows: without tombstones, and without what a truncate removed from buckets that no batch touched since."""
    rows = state.read("current")
    newest = rows.filter("__truncate").agg(F.max("__seq").alias("s")).first()["s"]
    alive = rows.filter("NOT __deleted AND NOT __truncate")
    if newest is not None:
        alive = alive.filter(F.col("__seq") > F.lit(newest).cast(rows.schema["__seq"].dataType))
    return alive.drop("__seq", "__deleted", "__truncate", "__tie")


def apply_history(state: KeyedState, rows: DataFrame, batch: int, sequence: str, **options) -> dict:
    """One batch into a historised dimension; options as in ``cdc.scd2``."""

    def change(tables: Mapping[str, DataFrame | None], new: DataFrame) -> dict[str, DataFrame]:
        held, dimension = tables["changes"], tables["dimension"]
        if held is None or dimension is None:
            return {"changes": new, "dimension": cdc.scd2(new, state.keys, sequence, **options)}
        after = cdc.scd2_refresh(dimension, held, new, state.keys, sequence, **options)
        return {"changes": held.unionByName(new), "dimension": after}

    return state.apply(rows, batch, change, ["changes", "dimension"])


def history(state: KeyedState) -> DataFrame:
    return state.read("dimension")


def _keep(apply: Callable[..., dict]):
    def keep(
        feed: DataFrame, root: str, checkpoint: str, keys: Sequence[str], sequence: str, buckets: int = 64,
        report: Callable[[dict], None] | None = None, **options,
    ) -> StreamingQuery:
        def work(rows: DataFrame, batch: int) -> None:
            done = apply(KeyedState(rows.sparkSession, root, keys, buckets), rows, batch, sequence, **options)
            if report is not None:
                report(done)

        return for_each_batch(feed, work, checkpoint)

    return keep


#: Streams into a dimension at ``root``; ``report`` gets the buckets read and written by every batch.
keep_current = _keep(apply_current)
keep_history = _keep(apply_history)


def read_current(spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    return current(KeyedState(spark, root, keys, buckets))


def read_history(spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    return history(KeyedState(spark, root, keys, buckets))
