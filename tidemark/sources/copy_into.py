"""Idempotent batch loads: files already loaded are skipped by path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import SchemaMismatch, check_constraints
from .files import missing_path

MAX_FILES = 1000


def _ledger(spark: SparkSession, state_dir: str) -> DataFrame:
    schema = "path STRING, load_id INT"
    try:
        return spark.read.schema(schema).parquet(f"{state_dir}/ledger")
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)


def _reader(spark: SparkSession, fmt: str, schema, options: Mapping[str, str]):
    defaults = {"csv": {"header": "true", "inferSchema": "true"}, "parquet": {"mergeSchema": "true"}}.get(fmt, {})
    reader = spark.read.format(fmt).options(**{**defaults, **options})
    return reader.schema(schema) if schema is not None else reader


def _listing(spark: SparkSession, source: str, pattern: str | None, files: Sequence[str] | None) -> DataFrame:
    if pattern and files:
        raise ValueError("a pattern and a file list exclude each other")
    if files is not None:
        if len(files) > MAX_FILES:
            raise ValueError(f"a file list may name at most {MAX_FILES} files")
        where = [f if "/" in f else f"{source.rstrip('/')}/{f}" for f in files]
    else:
        where = source
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(where).select("path")


def read_loaded(spark: SparkSession, target: str) -> DataFrame | None:
    """The target table, or None before the first load."""
    try:
        df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(target)
    except AnalysisException as e:
        # A load that died before its first file leaves a folder without a schema.
        if not missing_path(e) and e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return df


def copy_into(
    spark: SparkSession, source: str, target: str, state_dir: str, fmt: str = "parquet",
    schema: T.StructType | str | None = None, select: Sequence[str] | None = None, pattern: str | None = None,
    files: Sequence[str] | None = None, force: bool = False, merge_schema: bool = False,
    options: Mapping[str, str] | None = None,
) -> int:
    """Load the files not loaded before (all of them with ``force``); returns the number of rows.

    ``select`` holds SQL expressions that cast, rename or derive on load. A
    column the target lacks is refused unless ``merge_schema`` is set. Files
    count by path: a file changed in place is not loaded again.

    The load's folder is named after its number in the ledger and the ledger is
    written last, so a rerun after a crash overwrites instead of doubling.
    """
    ledger = _ledger(spark, state_dir)
    listing = _listing(spark, source, pattern, files)
    new = listing if force else listing.join(ledger.select("path"), "path", "left_anti")
    paths = sorted(r["path"] for r in new.collect())  # names only
    if not paths:
        return 0
    rows = _reader(spark, fmt, schema, options or {}).load(paths)
    if select is not None:
        rows = rows.selectExpr(*select)
    have = read_loaded(spark, target)
    if have is not None:
        extra = [c for c in rows.columns if c not in have.columns]
        if extra and not merge_schema:
            raise SchemaMismatch(f"the target has no columns {extra}")
        kinds = {f.name: f.dataType for f in have.schema.fields}
        rows = rows.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in rows.columns])
    last = ledger.agg(F.max("load_id").alias("m")).first()["m"]
    load_id = 0 if last is None else last + 1
    out = f"{target}/load={load_id:08d}"
    rows.write.mode("overwrite").parquet(out)
    entries = [(p, load_id) for p in paths]
    spark.createDataFrame(entries, "path STRING, load_id INT").coalesce(1).write.mode("append").parquet(f"{state_dir}/ledger")
    return spark.read.parquet(out).count()


def validate(
    spark: SparkSession, source: str, fmt: str = "parquet", rows: int | None = 15, schema: T.StructType | str | None = None,
    select: Sequence[str] | None = None, pattern: str | None = None, files: Sequence[str] | None = None,
    not_null: Sequence[str] = (), checks: Mapping[str, str] | None = None, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Dry run: the first rows of all files, or with ``rows=None`` all of them, parsed and checked; nothing is written."""
    paths = sorted(r["path"] for r in _listing(spark, source, pattern, files).collect())  # names only
    strict = {"mode": "FAILFAST", **(options or {})} if fmt in ("json", "csv") else dict(options or {})
    df = _reader(spark, fmt, schema, strict).load(paths)
    if select is not None:
        df = df.selectExpr(*select)
    return check_constraints(df if rows is None else df.limit(rows), not_null, checks)
