"""Physical layout of Parquet directories: statistics, skipping, compaction and clustering."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.scalar import interpolate
from ..session import materialize, settings
from ..sources import swap
from ..sources.files import list_files
from ..sources.footers import kept_stats
from .index import files_holding
from .ordered import position
from .sizes import broadcast_if_small
from .skew import row_salt

MB = 1024 * 1024
GB = 1024 * MB

_PARTS = r"/([^/=]+=[^/]+)(?=/)"


# --- statistics and skipping ---------------------------------------------------


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """File count, bytes and average size per directory partition."""
    return (
        list_files(spark, path)
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.avg("length").alias("avg_bytes"))
    )


def column_file_stats(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """Rows, and min, max and NULL count of each column, per file of a directory.

    They come from the footers, kept beside the data (``sources.footers``). Min
    and max are NULL where a file does not state them for all its row groups that
    hold values, the NULL count where one is missing.
    """
    groups = kept_stats(spark, root)
    parts = [F.sum("rows").alias("rows")]
    for c in columns:
        low, high, nulls = (F.col(f"`{kind}_{c}`") for kind in ("min", "max", "nulls"))
        blank = low.isNull() & ~F.coalesce(nulls == F.col("rows"), F.lit(False))
        whole = F.count_if(blank) == 0
        parts += [
            F.when(whole, F.min(low)).alias(f"min_{c}"), F.when(whole, F.max(high)).alias(f"max_{c}"),
            F.when(F.count_if(nulls.isNull()) == 0, F.sum(nulls)).alias(f"nulls_{c}"),
        ]
    return groups.groupBy("file").agg(*parts)


def skip_plan(stats: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Files whose values can lie in every ``(low, high)`` range; an open end is None.

    A file without min and max for a column is kept, unless all its values are NULL.
    """
    keep = F.lit(True)
    for c, (low, high) in ranges.items():
        kind = stats.schema[f"min_{c}"].dataType
        least, most = F.col(f"`min_{c}`"), F.col(f"`max_{c}`")
        hit = F.lit(True)
        if low is not None:
            hit = hit & (most >= F.lit(low).cast(kind))
        if high is not None:
            hit = hit & (least <= F.lit(high).cast(kind))
        unknown = least.isNull() | most.isNull()
        if f"nulls_{c}" in stats.columns and (low is not None or high is not None):
            unknown = unknown & ~F.coalesce(F.col(f"`nulls_{c}`") == F.col("rows"), F.lit(False))
        keep = keep & F.coalesce(unknown | hit, F.lit(False))
    return stats.filter(keep)


def in_ranges(df: DataFrame, ranges: Mapping[str, tuple]) -> Column:
    ok = F.lit(True)
    for c, (low, high) in ranges.items():
        kind = df.schema[c].dataType
        if low is not None:
            ok = ok & (F.col(c) >= F.lit(low).cast(kind))
        if high is not None:
            ok = ok & (F.col(c) <= F.lit(high).cast(kind))
    return ok


def read_skipping(spark: SparkSession, root: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Scan only the files whose kept statistics meet the ranges, then apply the ranges to the rows.

    File names are the only thing brought to the driver, which needs them to
    plan any scan.
    """
    schema = spark.read.option("mergeSchema", "true").parquet(root).schema
    chosen = skip_plan(column_file_stats(spark, root, list(ranges)), ranges)
    names = [r["file"] for r in chosen.select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", root).parquet(*names)
    return df.filter(in_ranges(df, ranges))


def partition_advice(df: DataFrame, columns: Sequence[str], table_bytes: int, floor_bytes: int = GB) -> DataFrame:
    """One row per candidate column: distinct values, bytes per directory and whether that reaches the floor."""
    counts = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns])
    per = counts.unpivot([], list(columns), "column", "n_values")
    size = F.lit(float(table_bytes)) / F.greatest(F.col("n_values"), F.lit(1))
    return per.withColumn("bytes_per_value", size).withColumn("advised", F.col("bytes_per_value") >= floor_bytes)


def target_file_mb(table_gb: Column) -> Column:
    """256 MB up to 2.56 TB, 1024 MB from 10 TB on, linear between."""
    return interpolate(table_gb, 2560, 256, 10000, 1024)


def target_file_bytes(table_bytes: int) -> int:
    gb = table_bytes / GB
    share = min(max((gb - 2560) / (10000 - 2560), 0.0), 1.0)
    return int((256 + share * (1024 - 256)) * MB)


# --- writes --------------------------------------------------------------------


def write_right_sized(df: DataFrame, path: str, partition_by: Sequence[str] = (), target_bytes: int = 128 * MB, mode: str = "errorifexists") -> None:
    """Shuffle before the write so each directory gets few files of about ``target_bytes``.

    The rebalance lets adaptive execution split a large directory over several
    tasks and merge small ones.
    """
    spark = df.sparkSession
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}):
        writer = df.hint("rebalance", *partition_by).write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Data files with the partition folder spelled as in the file metadata of a scan."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length", F.col("_metadata.file_path").alias("uri"))
        .withColumn("folder", F.array_join(F.regexp_extract_all("uri", F.lit(_PARTS), F.lit(1)), "/"))
        .withColumn("leaf", F.element_at(F.split("path", "/"), -1))
    )


def _partition_columns(folder: str) -> list[str]:
    return [part.split("=", 1)[0] for part in folder.split("/")] if folder else []


_MARK = "compacted-"


def plan_bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """``files`` with ``bin`` and ``tasks``: the bin of a file, numbered over all folders, and how many bins there are.

    A folder's files follow each other by size, and a bin is a stretch of about
    ``target_bytes`` of their running sum: no bin is empty, none is shared by two
    folders, and none takes a second file once it is full.
    """
    order = Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    cut = files.withColumn("_b", F.floor(F.coalesce(F.sum("length").over(order), F.lit(0)) / F.lit(target_bytes)))
    # Bins and folders are few beside rows: numbers of the bins that exist, one after the other.
    bins = cut.select("folder", "_b").distinct()
    per_folder = bins.groupBy("folder").agg(F.count(F.lit(1)).alias("_n"))
    before = per_folder.withColumn("_before", F.sum("_n").over(Window.orderBy("folder")) - F.col("_n"))
    within = F.dense_rank().over(Window.partitionBy("folder").orderBy("_b")) - 1
    placed = cut.withColumn("_w", within).join(before, "folder")
    return placed.withColumn("bin", (F.col("_before") + F.col("_w")).cast("int")).drop("_b", "_w", "_before", "_n")


def compact(spark: SparkSession, root: str, target_bytes: int, folder_like: str | None = None) -> dict[str, int]:
    """Merge the small files of every directory partition into files of about ``target_bytes``.

    Files of the target size or more are left alone, and so are directories
    without a new small file, which makes a second call do nothing. Whole files
    go to a bin, so rows keep their neighbours; each bin is one task and one
    file. ``folder_like`` restricts the job to matching partition folders (SQL
    LIKE).
    """
    with swap.owned(spark, root):
        small = _listing(spark, root).filter(F.col("length") < target_bytes)
        if folder_like is not None:
            small = small.filter(F.col("folder").like(folder_like))
        planned = plan_bins(small, target_bytes)
        due = (
            planned.groupBy("folder")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bin").alias("bins"), F.count_if(~F.col("leaf").startswith(_MARK)).alias("fresh"))
            .filter("fresh > 0 AND n > bins")
        )
        # Bins of the folders that are due, numbered anew without gaps.
        chosen = materialize(plan_bins(small.join(due.select("folder"), "folder", "left_semi"), target_bytes), "bins")
        # Names of the files to read; a scan needs them in the driver.
        names = chosen.select("path", "folder", "bin").collect()
        if not names:
            return {"files_removed": 0, "files_added": 0}
        paths = [r["path"] for r in names]
        stage = swap.staging(root)
        _pack(spark, root, paths, chosen, 1 + max(r["bin"] for r in names), _partition_columns(names[0]["folder"]), stage)
        return {"files_removed": len(paths), "files_added": swap.exchange(spark, root, stage, paths, _MARK)}


# Partition values are copied as they are spelled, never read as numbers and written back another way.
_AS_SPELLED = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def _pack(spark: SparkSession, root: str, paths: Sequence[str], bins: DataFrame, tasks: int, by: Sequence[str], stage: str) -> None:
    """Send the rows of every file to the task of its bin, which writes one file."""
    with settings(spark, _AS_SPELLED):
        rows = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths)
        numbered = broadcast_if_small(bins.select(F.col("uri").alias("_uri"), F.col("bin").alias("_bin")))
        placed = rows.withColumn("_uri", F.col("_metadata.file_path")).join(numbered, "_uri")
        laid = placed.repartitionById(tasks, "_bin").select(*rows.columns)
        (laid.write.partitionBy(*by) if by else laid.write).parquet(stage)


# --- multi-dimensional clustering -------------------------------------------------


def _cut_points(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list]:
    """Approximate quantiles of numbers and times; for other columns the values at which Spark's ranges of them begin."""
    shares = [i / buckets for i in range(1, buckets)]
    numbers = [c for c in columns if isinstance(df.select(position(df, c)).schema[0].dataType, T.DoubleType)]
    cuts: dict[str, list] = {}
    if numbers:
        row = df.agg(*[F.percentile_approx(position(df, c), shares, 1000).alias(c) for c in numbers]).first()
        cuts = {c: sorted(set(row[c] or [])) for c in numbers}
    for c in columns:
        if c not in cuts:
            ranged = df.select(F.col(c).alias("_at")).filter("_at IS NOT NULL").repartitionByRange(buckets, "_at")
            starts = ranged.select("_at", F.spark_partition_id().alias("_p")).groupBy("_p").agg(F.min("_at").alias("_at"))
            cuts[c] = sorted({r["_at"] for r in starts.collect()})[1:]
    return cuts


def bucket_number(value: Column, cuts: Sequence) -> Column:
    """Number of cut points at or below the value (NULL = 0), as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < F.lit(cuts[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(tree(0, len(cuts)))


def with_zvalue(df: DataFrame, columns: Sequence[str], name: str, bits: int = 5) -> DataFrame:
    """Add the interleaved bits of the columns' quantile buckets."""
    df, helpers = _bucketed(df, columns, bits)
    return df.withColumn(name, _interleaved([F.col(h) for h in helpers], bits)).drop(*helpers)


def _bucketed(df: DataFrame, columns: Sequence[str], bits: int) -> tuple[DataFrame, list[str]]:
    cuts = _cut_points(df, columns, 2**bits)
    helpers = [f"_b{i}" for i in range(len(columns))]
    for c, helper in zip(columns, helpers):
        df = df.withColumn(helper, bucket_number(position(df, c), cuts[c]).cast("long"))
    return df, helpers


def _interleaved(values: Sequence[Column], bits: int) -> Column:
    """Bits of the values in turn, the first value's highest bit on top."""
    z, one, n = F.lit(0).cast("long"), F.lit(1).cast("long"), len(values)
    for i, v in enumerate(values):
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(v, b).bitwiseAND(one), b * n + n - 1 - i))
    return z


def with_hilbert(df: DataFrame, columns: Sequence[str], name: str, bits: int) -> DataFrame:
    """Add the place of the columns' quantile buckets along a Hilbert curve, on which neighbours always touch."""
    df, axes = _bucketed(df, columns, bits)
    return along_hilbert(df, axes, name, bits).drop(*axes)


def along_hilbert(df: DataFrame, axes: Sequence[str], name: str, bits: int) -> DataFrame:
    """Add the place along a Hilbert curve of cells whose coordinates, longs of ``bits`` bits, stand in ``axes``.

    The coordinates are turned into the curve's axes bit by bit from the top, so that
    interleaving their bits gives the place. Every step is a column expression
    on the last one, and ``axes`` are used up.
    """
    first = axes[0]
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for axis in axes:
            set_ = F.col(axis).bitwiseAND(F.lit(q)) != 0
            swap_ = F.col(first).bitwiseXOR(F.col(axis)).bitwiseAND(F.lit(low))
            flipped = F.col(first).bitwiseXOR(F.when(set_, F.lit(low).cast("long")).otherwise(swap_))
            moved = F.col(axis).bitwiseXOR(F.when(set_, F.lit(0).cast("long")).otherwise(swap_))
            if axis == first:
                df = df.withColumn(first, F.when(set_, F.col(first).bitwiseXOR(F.lit(low))).otherwise(F.col(first)))
            else:
                df = df.withColumns({first: flipped, axis: moved})
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    turn = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        turn = F.when(F.col(axes[-1]).bitwiseAND(F.lit(1 << level)) != 0, turn.bitwiseXOR(F.lit((1 << level) - 1))).otherwise(turn)
    df = df.withColumn("_turn", turn)
    place = _interleaved([F.col(a).bitwiseXOR(F.col("_turn")) for a in axes], bits)
    return df.withColumn(name, place).drop("_turn")


def curve_bits(columns: int, n_files: int) -> int:
    """Bits a column: enough cells for sixteen to a file, at most 62 bits in all and 4096 cuts a column."""
    return max(2, min(math.ceil(math.log2(16 * max(n_files, 2)) / columns), 62 // columns, 12))


def zorder(df: DataFrame, columns: Sequence[str], n_files: int, bits: int | None = None, curve: str = "hilbert") -> DataFrame:
    """The same rows, range-partitioned along a space-filling curve over the columns.

    The number of bits follows the number of files. A salt follows the curve
    value, so many rows with one value still spread over several partitions.
    """
    bits = bits or curve_bits(len(columns), n_files)
    if len(columns) * bits > 62:
        raise ValueError("too many bits for one curve value")
    place = {"hilbert": with_hilbert, "z": with_zvalue}[curve]
    curved = place(df.withColumn("_s", row_salt(df, 1024)), columns, "_z", bits)
    return curved.repartitionByRange(n_files, "_z", "_s").sortWithinPartitions("_z", *columns).drop("_z", "_s")


def zorder_rewrite(
    spark: SparkSession, root: str, columns: Sequence[str], n_files: int, bits: int | None = None, folder_like: str | None = None
) -> dict[str, int]:
    """Rewrite the files of a directory, or of its matching partition folders, in curve order."""
    with swap.owned(spark, root):
        files = _listing(spark, root)
        if folder_like is not None:
            files = files.filter(F.col("folder").like(folder_like))
        return _rewrite(spark, root, files, lambda df: zorder(df, columns, n_files, bits))


def _rewrite(spark: SparkSession, root: str, files: DataFrame, change, mark: str = "") -> dict[str, int]:
    chosen = files.select("path", "folder").collect()
    if not chosen:
        return {"files_removed": 0, "files_added": 0}
    paths = [r["path"] for r in chosen]
    by = _partition_columns(chosen[0]["folder"])
    stage = swap.staging(root)
    with settings(spark, _AS_SPELLED if by else {}):
        rows = change(spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths))
        (rows.write.partitionBy(*by) if by else rows.write).parquet(stage)
    return {"files_removed": len(paths), "files_added": swap.exchange(spark, root, stage, paths, mark)}


def _cluster_mark(keys: Sequence[str]) -> str:
    return "clustered-" + "-".join(k.replace(".", "_") for k in keys) + "-"


def cluster_rewrite(
    spark: SparkSession, root: str, keys: Sequence[str], n_files: int, full: bool = False, folder_like: str | None = None, bits: int | None = None
) -> dict[str, int]:
    """Cluster by up to four keys, nested fields included.

    Only files not yet clustered by the current keys are rewritten, unless
    ``full`` asks for all of them. The keys are noted in the file names, so
    changing them makes older files due again only in a full run.
    """
    if not 1 <= len(keys) <= 4:
        raise ValueError("give one to four clustering keys")
    mark = _cluster_mark(keys)

    def change(df: DataFrame) -> DataFrame:
        flat, helpers = df, []
        for k in keys:
            if "." in k:
                name = "_k_" + k.replace(".", "_")
                flat, helpers = flat.withColumn(name, F.col(k)), [*helpers, name]
        names = ["_k_" + k.replace(".", "_") if "." in k else k for k in keys]
        return zorder(flat, names, n_files, bits).drop(*helpers)

    with swap.owned(spark, root):
        files = _listing(spark, root)
        if folder_like is not None:
            files = files.filter(F.col("folder").like(folder_like))
        if not full:
            files = files.filter(~F.col("leaf").startswith("clustered-"))
        return _rewrite(spark, root, files, change, mark)


def purge_deletes(spark: SparkSession, root: str, deleted: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Physically remove rows with the given keys; only files holding such rows are rewritten.

    The kept index names these files (``operators.index``). Rewritten files keep
    the mark of the job that laid them out, so that it does not take them for new.
    """
    keys = list(keys)
    with swap.owned(spark, root):
        marked = materialize(deleted.select(*keys).distinct(), "purged")
        touched = files_holding(spark, root, marked, keys)
        marks: dict[str, list[str]] = {}
        for path in touched:
            marks.setdefault(mark_of(path), []).append(path)
        report = {"files_removed": 0, "files_added": 0}
        for mark, paths in sorted(marks.items()):
            files = _listing(spark, root).filter(F.col("path").isin(paths))
            done = _rewrite(spark, root, files, lambda df: df.join(marked, keys, "left_anti").select(*df.columns), mark)
            report = {k: n + done[k] for k, n in report.items()}
        return report


def mark_of(path: str) -> str:
    """What a layout job put before the name of a file."""
    leaf = path.rsplit("/", 1)[-1]
    return leaf[: leaf.find("part-")] if leaf.startswith((_MARK, "clustered-")) and "part-" in leaf else ""


def table_bytes(spark: SparkSession, root: str) -> int:
    return _listing(spark, root).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()["b"]


def file_count(spark: SparkSession, root: str) -> int:
    return _listing(spark, root).count()


def files_needed(table: int, target: int) -> int:
    return max(1, math.ceil(table / target))
