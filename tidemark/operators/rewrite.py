"""Merges, updates and deletes on a directory that rewrite only the files they touch.

The rows of touched files are read, changed and staged; one exchange puts the new
files in their place. All other files keep their names and bytes. Files are found
by the kept key index (merges) or by a scan of the columns of the condition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from ..session import materialize
from ..sources import swap
from .index import files_holding, files_where
from .merge import Delete, Insert, Update, delete_where, merge, update_where


def _partitions(files: Sequence[str], root: str) -> list[str]:
    """Partition columns, from the folders of a file below the root."""
    if not files:
        return []
    base = root.rstrip("/").rsplit("/", 1)[-1]
    inside = files[0].rsplit(f"/{base}/", 1)[-1].split("/")[:-1]
    return [part.split("=", 1)[0] for part in inside if "=" in part]


def _exchange(spark: SparkSession, root: str, after: DataFrame, touched: Sequence[str], every: Sequence[str]) -> dict[str, int]:
    by = _partitions(every, root)
    stage = swap.staging(root)
    # Rows of one folder meet in few tasks; adaptive execution splits large ones.
    laid = after.hint("rebalance", *by) if by else after
    (laid.write.partitionBy(*by) if by else laid.write).parquet(stage)
    added = swap.exchange(spark, root, stage, touched)
    return {"files_kept": len(every) - len(touched), "files_removed": len(touched), "files_added": added}


def _rows(spark: SparkSession, root: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*files)


def merge_path(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[Update | Delete] = (Update(),),
    not_matched: Sequence[Insert] = (Insert(),),
    evolve: bool = False,
    guard: bool = True,
) -> dict[str, int]:
    """Merge ``source`` into the table at ``root``; clauses as in ``merge``.

    Only files that hold a key of the source are read and rewritten. New rows go
    to new files. Clauses on target rows without a match would touch every file;
    use ``merge`` with a staged overwrite for these. The source is stored first:
    all steps see the same rows, whatever it is computed from.
    """
    keys = list(keys)
    with swap.owned(spark, root):
        schema = spark.read.option("mergeSchema", "true").parquet(root).schema
        every = swap.data_files(spark, root)
        feed = materialize(source, "feed")
        touched = files_holding(spark, root, feed, keys, schema)
        after = merge(_rows(spark, root, schema, touched), feed, keys, matched, not_matched, evolve=evolve, guard=guard)
        return _exchange(spark, root, after, touched, every)


def update_path(spark: SparkSession, root: str, condition: Column | str, values: Mapping[str, str | Column]) -> dict[str, int]:
    """Set columns of the rows for which the condition is TRUE."""
    return _change(spark, root, condition, lambda df: update_where(df, condition, values))


def delete_path(spark: SparkSession, root: str, condition: Column | str) -> dict[str, int]:
    """Remove the rows for which the condition is TRUE."""
    return _change(spark, root, condition, lambda df: delete_where(df, condition))


def _change(spark: SparkSession, root: str, condition: Column | str, change) -> dict[str, int]:
    with swap.owned(spark, root):
        schema = spark.read.option("mergeSchema", "true").parquet(root).schema
        every = swap.data_files(spark, root)
        touched = files_where(spark, root, condition, schema)
        if not touched:
            return {"files_kept": len(every), "files_removed": 0, "files_added": 0}
        return _exchange(spark, root, change(_rows(spark, root, schema, touched)), touched, every)
