"""Exactly-once incremental file ingest with schema evolution and rescued data.

A file stream over the landing folder lists only paths and remembers which
files were handled; every micro-batch reads its files with the batch reader.
A batch is written to a folder named after its number, so a repeated batch
replaces its own output.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQueryException

from .files import missing_path

RESCUED = "_rescued_data"
MODES = ("addNewColumns", "addNewColumnsWithTypeWidening", "rescue", "failOnNewColumns", "none")

_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


class UnknownFieldError(ValueError):
    """New columns arrived. Where the mode allows, the stored schema already has them and a rerun succeeds."""


@dataclass(frozen=True)
class IngestResult:
    files: int
    rows: int
    schema_version: int


# --- stored schemas ------------------------------------------------------------


def stored_schemas(spark: SparkSession, state_dir: str) -> list[T.StructType]:
    """All versions of the stored schema, oldest first."""
    try:
        rows = spark.read.schema("version INT, body STRING").json(f"{state_dir}/schemas").collect()
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return []
    latest = {r["version"]: r["body"] for r in rows}
    return [T.StructType.fromJson(json.loads(latest[v])) for v in sorted(latest)]


def store_schema(spark: SparkSession, state_dir: str, schema: T.StructType, version: int) -> None:
    row = [(version, schema.json())]
    spark.createDataFrame(row, "version INT, body STRING").coalesce(1).write.mode("append").json(f"{state_dir}/schemas")


# --- schema comparison -----------------------------------------------------------

# Only steps that keep every value: a double holds no more than 53 bits of a bigint.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp", "timestamp_ntz"),
}


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The wider of two types if one can hold the other, else None."""
    a, b = old.simpleString(), new.simpleString()
    if a == b or a in _WIDER.get(b, ()):
        return old
    if b in _WIDER.get(a, ()):
        return new
    return None


def with_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """Pin types of named columns; a hinted column that was not seen is added."""
    if not hints:
        return schema
    pinned = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    fields = [pinned.pop(f.name, f) for f in schema.fields]
    return T.StructType([*fields, *pinned.values()])


def evolved(schema: T.StructType, seen: T.StructType, mode: str, pinned: set[str] = frozenset()) -> T.StructType:
    """The stored schema after a batch, by evolution mode."""
    fields = []
    arriving = {f.name: f for f in seen.fields}
    for f in schema.fields:
        new = arriving.pop(f.name, None)
        kind = f.dataType
        if mode == "addNewColumnsWithTypeWidening" and new is not None and f.name not in pinned:
            kind = widened(f.dataType, new.dataType) or f.dataType
        fields.append(T.StructField(f.name, kind, True))
    if mode.startswith("addNewColumns"):
        fields += [T.StructField(f.name, f.dataType, True) for f in arriving.values()]
    return T.StructType(fields)


# --- reading one batch of files ----------------------------------------------------


def _infer(spark: SparkSession, files: DataFrame, fmt: str, options: Mapping[str, str]) -> T.StructType:
    """Schema of all files of a batch, which is about to read them all."""
    return _schema_of(spark, sorted(r["path"] for r in files.select("path").collect()), fmt, options)


def _schema_of(spark: SparkSession, paths: list[str], fmt: str, options: Mapping[str, str]) -> T.StructType:
    if fmt == "json":
        schema = spark.read.options(**options).json(paths).schema
    elif fmt == "csv":
        schema = spark.read.options(**{"header": "true", "inferSchema": "true", **options}).csv(paths).schema
    else:
        schema = spark.read.options(**{"mergeSchema": "true", **options}).format(fmt).load(paths).schema
    return T.StructType([f for f in schema.fields if f.name != "_corrupt_record"])


def parse_json(lines: DataFrame, schema: T.StructType, rescue: bool = True) -> DataFrame:
    """Typed columns from JSON lines; values that do not fit go to the rescued column.

    ``lines`` has ``value`` and ``_file``. A line is parsed twice: to the
    schema, and to a map of untyped values. Keys outside the schema, and values
    present in the map but not in the typed row, are rescued with their
    original JSON; a line that is no JSON object is rescued whole.
    """
    parsed = lines.select(
        "value", "_file",
        F.from_json("value", schema).alias("row") if schema.fields else F.lit(None).cast("struct<_x:int>").alias("row"),
        F.from_json("value", "MAP<STRING, VARIANT>").alias("raw"),
    )
    columns = [F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields]
    if not rescue:
        return parsed.select(*columns)
    fits = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in schema.fields]), F.array(*[F.col(f"row.`{f.name}`").isNotNull() for f in schema.fields])
    ) if schema.fields else F.lit(None).cast("map<string,boolean>")

    def lost(key: Column, value: Column) -> Column:
        fitted = F.coalesce(F.try_element_at(fits, key), F.lit(False))
        return ~fitted & value.isNotNull() & ~F.is_variant_null(value)

    extras = F.map_filter("raw", lost)
    text = F.to_json(extras)
    whole = F.to_json(F.struct(F.col("value").alias("_corrupt_record")))
    rescued = F.when(F.col("raw").isNull(), F.when(F.length(F.trim("value")) > 0, whole)).when(F.size(extras) > 0, text)
    return parsed.filter(F.length(F.trim("value")) > 0).select(*columns, rescued.alias(RESCUED))


def parse_columns(df: DataFrame, schema: T.StructType, rescue: bool = True) -> DataFrame:
    """The same for files that carry columns: unknown columns and failed casts are rescued."""
    columns, lost = [], []
    have = set(df.columns)
    for f in schema.fields:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        cast = F.col(f.name).try_cast(f.dataType)
        columns.append(cast.alias(f.name))
        lost.append(F.when(cast.isNull(), F.col(f.name).cast("string")).alias(f.name))
    known = {f.name for f in schema.fields}
    lost += [F.col(c).cast("string").alias(c) for c in df.columns if c not in known]
    if not rescue:
        return df.select(*columns)
    text = F.to_json(F.struct(*lost)) if lost else F.lit(None).cast("string")
    return df.select(*columns, F.when(text != "{}", text).alias(RESCUED))


def _read(spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType, rescue: bool, options: Mapping[str, str]) -> DataFrame:
    if fmt == "json":
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"))
        return parse_json(lines, schema, rescue)
    if fmt == "csv":
        # Every value as text; the header must match in all files of one batch.
        raw = spark.read.options(**{"header": "true", "inferSchema": "false", "enforceSchema": "false", **options}).csv(paths)
    else:
        raw = spark.read.options(**{"mergeSchema": "true", **options}).format(fmt).load(paths)
    return parse_columns(raw, schema, rescue)


# --- the ingest job ------------------------------------------------------------------


def ingest(
    spark: SparkSession, source: str, state_dir: str, target: str, fmt: str = "json", mode: str = "addNewColumns",
    hints: str | None = None, max_files: int | None = None, max_bytes: str | None = None, glob: str | None = None,
    options: Mapping[str, str] | None = None,
) -> IngestResult:
    """Load files not seen before, then stop.

    By mode a new column: is added, after one failed run that stores the new
    schema and writes nothing (``addNewColumns``, and with wider types
    ``addNewColumnsWithTypeWidening``); is rescued (``rescue``); stops the load
    until ``hints`` names it (``failOnNewColumns``); is ignored (``none``).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    if max_files is not None and max_bytes is not None:
        raise ValueError("limit a batch by files or by bytes, not by both")
    options = dict(options or {})
    done = {"files": 0, "rows": 0}
    rescue = mode != "none"
    pinned = {f.name for f in T.StructType.fromDDL(hints).fields} if hints else set()

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = batch.select("path", "length")
        paths = [r["path"] for r in files.collect()]  # of one batch: bounded by max_files or max_bytes
        if not paths:
            return
        versions = stored_schemas(session, state_dir)
        if not versions:
            versions = [with_hints(_infer(session, files, fmt, options), hints)]
            store_schema(session, state_dir, versions[0], 0)
        schema = with_hints(versions[-1], hints)
        if schema != versions[-1]:
            versions.append(schema)
            store_schema(session, state_dir, schema, len(versions) - 1)
        if mode in ("addNewColumns", "addNewColumnsWithTypeWidening", "failOnNewColumns"):
            seen = _schema_of(session, paths, fmt, options)
            new = sorted(set(seen.names) - set(schema.names))
            after = evolved(schema, seen, mode, pinned)
            if new and mode == "failOnNewColumns":
                raise UnknownFieldError(f"UNKNOWN_FIELD {new}: add them to the hints")
            if after != schema:
                store_schema(session, state_dir, after, len(versions))
                if new:
                    raise UnknownFieldError(f"UNKNOWN_FIELD {new}: stored, run again")
                versions.append(after)
                schema = after
        rows = _read(session, paths, fmt, schema, rescue, options)
        out = f"{target}/schema_version={len(versions) - 1}/batch={batch_id:08d}"
        rows.write.mode("overwrite").parquet(out)
        done["files"] += len(paths)
        done["rows"] += session.read.parquet(out).count()

    reader = spark.readStream.schema(_LISTING).format("binaryFile").option("maxFilesPerTrigger", max_files or 1000)
    if max_bytes:
        reader = spark.readStream.schema(_LISTING).format("binaryFile").option("maxBytesPerTrigger", max_bytes)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.option("recursiveFileLookup", "true").load(source).select("path", "length")
    query = (
        listing.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as exc:
        if "UNKNOWN_FIELD" in str(exc):
            text = str(exc)
            start = text.index("UNKNOWN_FIELD")
            raise UnknownFieldError(text[start : start + 300].splitlines()[0]) from exc
        raise
    return IngestResult(done["files"], done["rows"], len(stored_schemas(spark, state_dir)) - 1)


def read_ingested(spark: SparkSession, state_dir: str, target: str, mode: str = "addNewColumns") -> DataFrame:
    """The loaded table in its newest schema; columns older files lack are NULL."""
    versions = stored_schemas(spark, state_dir)
    newest, out = versions[-1], None
    for n, schema in enumerate(versions):
        stored = T.StructType([*schema.fields, *([T.StructField(RESCUED, T.StringType())] if mode != "none" else [])])
        try:
            part = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(f"{target}/schema_version={n}")
        except AnalysisException as e:
            if not missing_path(e):
                raise
            continue  # no file came with this version of the schema
        shaped = part.select(
            *[
                (F.col(f.name) if f.name in schema.names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in newest.fields
            ],
            *([RESCUED] if mode != "none" else []),
        )
        out = shaped if out is None else out.unionByName(shaped)
    return out if out is not None else spark.createDataFrame([], newest)


def rescued_fields(df: DataFrame, schema: T.StructType | str, column: str = RESCUED) -> DataFrame:
    """Typed fields taken out of the rescued JSON."""
    return df.withColumn("_r", F.from_json(column, schema)).select(*df.columns, "_r.*")
