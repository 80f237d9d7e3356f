"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: Rows of one Arrow batch. Texts are kept whole, so few rows go to a worker at a time.
BATCH_ROWS = 512

_xxh64 = xxhash.xxh64_intdigest


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches and UTC for the jobs of the corpus operators."""
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.session.timeZone", "UTC"),
    ):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of lineage that any executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(*taken: Iterable[str]) -> str:
    """A column name that none of the given frames uses."""
    used = {c.lower() for cols in taken for c in cols}
    while (name := f"_{uuid.uuid4().hex[:12]}") in used:
        pass
    return name


def with_row_id(df: DataFrame, name: str, column: str) -> DataFrame:
    """Rows stored together with a number of their own, so that decisions made on a few columns join back to whole rows.

    Neither ids nor texts need be unique for that, and a recomputed task cannot number its rows anew.
    """
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def fold(column: str, modulus: int = 5) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def hash_share(share: float, *columns: str) -> Column:
    """Whether a row is among the ``share`` of smallest hash of ``columns``: the same rows at every run."""
    bound = int(min(max(share, 0.0), 1.0) * 2**32)
    return F.pmod(F.xxhash64(*columns), F.lit(2**32)) < bound


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: what ``bytes`` calls white space and letters."""
    return text.lower().split()


def shingle_hashes(tokens: list[bytes], n: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``n`` words joined by spaces, in order; fewer words make one shingle, none make none."""
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) <= n:
        return np.array([_xxh64(b" ".join(tokens), seed)], np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - n + 1].tolist()
    stops = ends[n - 1 :].tolist()
    return np.fromiter((_xxh64(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, len(starts))
