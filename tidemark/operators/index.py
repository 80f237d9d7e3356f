"""Which files of a directory can hold given keys: ranges and Bloom filters, kept beside the data.

Every run of at most ``RUN`` keys of a file has a row in the hidden folder
``_keys-...`` of the table: how many distinct keys, the range of the first key and
a Bloom filter of ``BITS`` bits a key. Only files that are not in the kept table
yet are read for it, and of them the key columns alone.

A lookup sends the hashes of the wanted keys to the rows of the index and returns
the files that may hold one. It never misses a file; up to ``LOOKUP`` distinct keys
go to the tasks, beyond that the key columns are searched by a join, which shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.files import read_kept
from ..sources.footers import data_files
from .ordered import position

RUN = 1 << 16
BITS = 16
PROBES = 3
LOOKUP = 4_000_000

_ROW = "file string, keys long, low double, high double, filter binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each hash in a filter of ``bits`` bits, a power of two: one row per probe."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = 1 << max(6, (BITS * len(hashes) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[_places(hashes, bits).ravel()] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def may_hold(held: bytes, hashes: np.ndarray) -> np.ndarray:
    words = np.frombuffer(held, np.uint8)
    at = _places(hashes, 8 * len(words))
    return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _usable(keys: Sequence[str]) -> Column:
    """Rows without a NULL key: NULL keys never match."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def _hashed(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Hash of the keys and the place of the first one on a number line, NULL where it has none."""
    place = position(df, keys[0])
    if not isinstance(df.select(place).schema[0].dataType, T.DoubleType):
        place = F.lit(None).cast("double")
    # NaN has no place in a range.
    place = F.when(~F.isnan(place), place)
    return df.filter(_usable(keys)).select(F.xxhash64(*keys).alias("h"), place.alias("p"), *more)


def _typed(df: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Keys in the types of the table, or equal keys of other types would have other hashes."""
    return df.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the index from ``file, h, p``; a run is closed when it is full or the task ends."""
    open_runs: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def close(file: str) -> pa.RecordBatch:
        parts = open_runs.pop(file)
        hashes = np.unique(np.concatenate([h for h, _ in parts]))
        places = np.concatenate([p for _, p in parts])
        known = len(places) and not np.isnan(places).any()
        low, high = (float(places.min()), float(places.max())) if known else (None, None)
        row = {"file": file, "keys": len(hashes), "low": low, "high": high, "filter": bloom(hashes)}
        return pa.RecordBatch.from_pylist(
            [row],
            schema=pa.schema(
                [("file", pa.string()), ("keys", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("filter", pa.binary())]
            ),
        )

    for batch in batches:
        coded = batch.column("file").dictionary_encode()
        codes = np.asarray(coded.indices)
        hashes = np.asarray(batch.column("h"))
        places = np.asarray(batch.column("p").cast(pa.float64()).fill_null(float("nan")))
        for code, file in enumerate(coded.dictionary.to_pylist()):
            mine = codes == code
            run = open_runs.setdefault(file, [])
            run.append((hashes[mine], places[mine]))
            if sum(len(h) for h, _ in run) >= RUN:
                yield close(file)
    for file in list(open_runs):
        yield close(file)


def _listed(uri: Column) -> Column:
    """A file name of row metadata, which is a URI, as listings spell it."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _folder(root: str, keys: Sequence[str]) -> str:
    return f"{root.rstrip('/')}/_keys-" + "-".join(keys)


def kept_index(spark: SparkSession, root: str, keys: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Index rows of the present files; files not indexed yet are read first.

    A file without a key has a row without keys, so that it is not read again.
    """
    keys = list(keys)
    place, here = _folder(root, keys), data_files(spark, root).select("file")

    before = read_kept(spark, place)
    fresh = [r["file"] for r in (here if before is None else here.join(before.select("file"), "file", "left_anti")).collect()]
    if fresh or before is None:
        if fresh:
            schema = schema or spark.read.option("mergeSchema", "true").parquet(root).schema
            df = spark.read.schema(schema).option("basePath", root).parquet(*fresh)
            file = F.col("_metadata.file_path").alias("file")
            runs = _hashed(df.select("*", file), keys, F.col("file")).mapInArrow(_runs, _ROW)
            runs = runs.withColumn("file", _listed(F.col("file")))
            blank = spark.createDataFrame([(f, 0) for f in fresh], "file string, keys long")
            blank = blank.select("file", "keys", *[F.lit(None).cast(k).alias(c) for c, k in (("low", "double"), ("high", "double"), ("filter", "binary"))])
            runs = runs.unionByName(blank)
        else:
            runs = spark.createDataFrame([], _ROW)
        runs.write.mode("append").parquet(place)
    return read_kept(spark, place).join(here, "file", "left_semi")


def files_with(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], schema: T.StructType | None = None) -> list[str]:
    """Names of the files that may hold one of the keys of ``wanted``; none that does is missing."""
    keys = list(keys)
    schema = schema or spark.read.option("mergeSchema", "true").parquet(root).schema
    distinct = _hashed(_typed(wanted, schema, keys), keys).distinct()
    index = kept_index(spark, root, keys, schema).filter("keys > 0")
    if distinct.limit(LOOKUP + 1).count() > LOOKUP:
        return _by_join(spark, root, wanted, keys, schema, None)
    found = distinct.toArrow()
    hashes = np.asarray(found["h"].combine_chunks()).astype(np.int64)
    if not len(hashes):
        return []
    places = np.asarray(found["p"].combine_chunks().cast(pa.float64()).fill_null(float("nan")))
    order = np.argsort(places, kind="stable")  # unknown places come last
    shared = spark.sparkContext.broadcast((hashes[order], places[order]))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, places = shared.value
        known = int(np.searchsorted(places, np.nan))
        for batch in batches:
            hits = set()
            for row in batch.to_pylist():
                if row["file"] in hits:
                    continue
                if row["low"] is None:
                    near = hashes
                else:
                    a, b = np.searchsorted(places[:known], row["low"]), np.searchsorted(places[:known], row["high"], "right")
                    near = np.concatenate((hashes[a:b], hashes[known:]))
                if len(near) and may_hold(row["filter"], near).any():
                    hits.add(row["file"])
            yield pa.record_batch([pa.array(sorted(hits), pa.string())], names=["file"])

    return [r["file"] for r in index.select("file", "low", "high", "filter").mapInArrow(probe, "file string").distinct().collect()]


def _by_join(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], schema: T.StructType, files: Sequence[str] | None) -> list[str]:
    if files is not None and not files:
        return []
    scan = spark.read.schema(schema).option("basePath", root).parquet(*(files if files is not None else [root]))
    held = scan.select(*keys, F.col("_metadata.file_path").alias("_file"))
    hit = held.join(_typed(wanted, schema, keys).distinct(), list(keys), "left_semi").select("_file").distinct()
    return [r["file"] for r in hit.select(_listed(F.col("_file")).alias("file")).collect()]


def files_where(spark: SparkSession, root: str, condition: Column | str, schema: T.StructType) -> list[str]:
    """Names of the files with a row for which the condition is TRUE; the scan skips row groups that cannot have one."""
    scan = spark.read.schema(schema).option("basePath", root).parquet(root)
    hit = scan.filter(condition).select(F.col("_metadata.file_path").alias("uri")).distinct()
    return [r["file"] for r in hit.select(_listed(F.col("uri")).alias("file")).collect()]


def files_holding(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], schema: T.StructType | None = None) -> list[str]:
    """Names of the files that do hold one of the keys: what the index names, confirmed by their key columns."""
    schema = schema or spark.read.option("mergeSchema", "true").parquet(root).schema
    return _by_join(spark, root, wanted, list(keys), schema, files_with(spark, root, wanted, keys, schema))
