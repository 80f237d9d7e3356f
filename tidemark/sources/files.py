"""File scans, directory listings and table writes."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.skew import row_salt
from . import swap


def missing_path(error: AnalysisException) -> bool:
    """Whether a read failed only because its path does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_kept(spark: SparkSession, path: str) -> DataFrame | None:
    """A table an earlier call may have kept; None if none did, or if one died before it wrote a file."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def scan_parquet(spark: SparkSession, path: str | Sequence[str], merge_schema: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return spark.read.json(path, schema=schema) if schema is not None else spark.read.json(path)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True, sep: str = ","
) -> DataFrame:
    """CSV scan; with no schema the types are inferred in a second pass over the files."""
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    return reader.csv(path, schema=schema) if schema is not None else reader.option("inferSchema", "true").csv(path)


def with_file_metadata(df: DataFrame, path_col: str = "_source_file", time_col: str = "_load_time") -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(path_col), F.current_timestamp().alias(time_col))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per data file with its size and ``a=b/c=d`` directory partition.

    Only the listing columns are read, never the contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    parts = F.regexp_extract_all("path", F.lit(r"/([^/=]+=[^/]+)(?=/)"), F.lit(1))
    return files.withColumn("partition", F.array_join(parts, "/"))


def list_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Directory partitions of a dataset with file and byte counts."""
    return (
        list_files(spark, path)
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] | Mapping[str, Column],
    mode: str = "errorifexists",
    max_partitions: int = 10_000,
) -> None:
    """Write one directory per value; a mapping derives coarser keys, such as a month.

    Warns when the estimated number of directories is above ``max_partitions``.
    """
    if isinstance(by, Mapping):
        for name, col in by.items():
            df = df.withColumn(name, col)
        by = list(by)
    estimate = df.agg(F.approx_count_distinct(F.struct(*by)).alias("n")).first()["n"]
    if estimate > max_partitions:
        warnings.warn(f"partitioning by {list(by)} makes about {estimate} directories", stacklevel=2)
    df.write.mode(mode).partitionBy(*by).parquet(path)


def bucket_spread(df: DataFrame, buckets: int, keys: Sequence[str], most: float = 1.5) -> dict[int, int]:
    """Tasks that share the writing of each bucket: none gets more than about ``most`` times an even part of the rows."""
    number = F.pmod(F.hash(*keys), F.lit(buckets)).alias("b")
    sizes = {r["b"]: r["n"] for r in df.groupBy(number).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per bucket
    even = max(sum(sizes.values()) / buckets, 1)
    return {b: max(1, math.ceil(n / (most * even))) for b, n in sizes.items()}


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str], sort: Sequence[str] = (), spread: int | None = None
) -> None:
    """Bucketed and sorted table, one file per bucket and task.

    Rows are sent straight to a task of their bucket, so no task writes more
    than one bucket. How many tasks share a bucket follows from its measured
    size, so that a hot key is written by several; ``spread`` sets one number
    for all buckets instead.
    """
    shared = dict.fromkeys(range(buckets), spread) if spread else bucket_spread(df, buckets, keys)
    parts = [shared.get(b, 1) for b in range(buckets)]
    starts = [sum(parts[:b]) for b in range(buckets)]
    laid, salt = df, F.lit(0)
    if max(parts) > 1:
        laid = laid.withColumn("_salt", row_salt(df, max(parts)))
        salt = F.pmod(F.col("_salt"), F.get(F.array(*map(F.lit, parts)), F.col("_b")))
    laid = laid.withColumn("_b", F.pmod(F.hash(*keys), F.lit(buckets)))
    task = F.get(F.array(*map(F.lit, starts)), F.col("_b")) + salt
    laid = laid.withColumn("_task", task.cast("int"))
    laid = laid.repartitionById(sum(parts), "_task").select(*df.columns)
    (
        laid.write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*(sort or keys))
        .saveAsTable(table)
    )


def create_table_as(df: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """New table from a query.

    ``replace`` also accepts an existing one of another schema: the new files are
    staged and exchanged for the old ones, so the query may read the old table,
    and one that fails leaves it as it was.
    """
    spark = df.sparkSession
    if replace and swap.exists(spark, path):
        with swap.owned(spark, path):
            stage = swap.staging(path)
            df.write.parquet(stage)
            swap.exchange(spark, path, stage, swap.data_files(spark, path))
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def create_like(df: DataFrame, path: str) -> DataFrame:
    """Empty table with the columns of ``df``."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    empty.write.parquet(path)
    return df.sparkSession.read.parquet(path)
