"""Statistics of Parquet files from their footers, kept as a table beside the data.

A footer holds rows, minimum, maximum and NULL count of every column of every row
group, so no data page is read. Files are opened by the tasks of a job over the
file listing. What was read once stays in the hidden folder ``_stats`` of the
table, which no scan of the table sees; later calls read the footers of new files
only, and rows of files that are gone are left out on reading.

Tasks open files through Arrow: local paths and the stores that
``pyarrow.fs.FileSystem.from_uri`` knows.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from decimal import Decimal
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .files import read_kept

FOLDER = "_stats"

#: Types whose footer statistics are those of the values; others stay unknown.
_ORDERED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
)

_ARROW = {
    "boolean": pa.bool_(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(),
    "float": pa.float32(), "double": pa.float64(), "string": pa.string(), "date": pa.date32(),
    "timestamp": pa.timestamp("us", "UTC"), "timestamp_ntz": pa.timestamp("us"),
}


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """``file, length, modified`` of the visible data files below a directory."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    )


def open_file(path: str):
    """A file by its Hadoop path, opened for reading at any place."""
    local = re.match(r"^(?:file:)?/+", path)
    if local:
        return pa.OSFile("/" + path[local.end():], "rb")
    scheme, rest = path.split("://", 1)
    system, inner = pafs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")
    return system.open_input_file(inner)


def leaves(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """Atomic columns with an order, fields of structs under their dotted names."""
    found: dict[str, T.DataType] = {}
    for field in schema.fields:
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            found |= leaves(field.dataType, name + ".")
        elif isinstance(field.dataType, _ORDERED):
            found[name] = field.dataType
    return found


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return pa.string() if isinstance(kind, T.StringType) else _ARROW[kind.simpleString()]


def _value(value, kind: T.DataType):
    """A statistic as a value of the column's type, or None where it does not say one."""
    if isinstance(kind, T.DecimalType):
        if isinstance(value, int):
            return Decimal(value).scaleb(-kind.scale)
        return value if isinstance(value, Decimal) else None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else None
    if isinstance(kind, T.DateType):
        return value if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if not isinstance(value, dt.datetime) or (value.tzinfo is not None) != isinstance(kind, T.TimestampType):
            return None
        return value
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(value) if isinstance(value, (int, float)) and value == value else None
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def _groups(path: str, columns: dict[str, T.DataType]) -> Iterator[dict]:
    with open_file(path) as source:
        footer = pq.ParquetFile(source).metadata
        for g in range(footer.num_row_groups):
            group = footer.row_group(g)
            row = {"row_group": g, "rows": group.num_rows}
            for c in range(group.num_columns):
                chunk = group.column(c)
                name = chunk.path_in_schema
                kept = chunk.statistics if name in columns and chunk.is_stats_set else None
                if kept is None:
                    continue
                if kept.has_null_count:
                    row[f"nulls_{name}"] = kept.null_count
                if kept.has_min_max:
                    low, high = _value(kept.min, columns[name]), _value(kept.max, columns[name])
                    if low is not None and high is not None:
                        row[f"min_{name}"], row[f"max_{name}"] = low, high
            yield row


def read_footers(files: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per row group of ``files (file, length, modified)``: rows, and minimum, maximum and NULLs per column."""
    spark = files.sparkSession
    columns = leaves(schema)
    fields = [*files.select("file", "length", "modified").schema.fields]
    fields += [T.StructField("row_group", T.IntegerType()), T.StructField("rows", T.LongType())]
    for name, kind in columns.items():
        fields += [T.StructField(f"min_{name}", kind), T.StructField(f"max_{name}", kind)]
        fields.append(T.StructField(f"nulls_{name}", T.LongType()))
    out = T.StructType(fields)
    shape = pa.schema([(f.name, _arrow(f.dataType)) for f in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.to_pylist():
                rows += [{**file, **g} for g in _groups(file["file"], columns)]
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    # Footers wait on the store, not on the processor: a fixed number of tasks, which adaptive execution leaves alone.
    tasks = 4 * spark.sparkContext.defaultParallelism
    return files.select("file", "length", "modified").repartition(tasks, "file").mapInArrow(read, out)


def kept_stats(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Statistics per row group of the present files; reads the footers of files that are not in the kept table yet.

    A file counts as the same while path, size and time of change stay. Columns
    added since a file was written are unknown for it.
    """
    schema = schema or spark.read.option("mergeSchema", "true").parquet(root).schema
    place = f"{root.rstrip('/')}/{FOLDER}"
    here = data_files(spark, root)
    same = ["file", "length", "modified"]

    before = read_kept(spark, place)
    fresh = here if before is None else here.join(before.select(*same), same, "left_anti")
    if before is None or not fresh.isEmpty():
        read_footers(fresh, schema).write.mode("append").parquet(place)
    known = read_kept(spark, place)
    for name in (n for c in leaves(schema) for n in (f"min_{c}", f"max_{c}", f"nulls_{c}")):
        if name not in known.columns:
            kind = "long" if name.startswith("nulls_") else leaves(schema)[name[4:]]
            known = known.withColumn(name, F.lit(None).cast(kind))
    return known.join(here, same, "left_semi").dropDuplicates(["file", "row_group"])
