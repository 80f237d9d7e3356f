"""Message-log records: decoding, encoding and reader options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

RECORD = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"


def decode(
    records: DataFrame,
    schema: T.StructType | str,
    keep: Sequence[str] = ("topic", "partition", "offset", "timestamp"),
) -> DataFrame:
    """Parse the binary JSON ``value`` and keep the record's coordinates."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return records.select(parsed.alias("_d"), *keep).select("_d.*", *keep)


def encode(df: DataFrame, key: str | Column, columns: Sequence[str] = ()) -> DataFrame:
    """Rows as ``key STRING, value JSON`` for a message sink."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.cast("string").alias("key"), F.to_json(F.struct(*(columns or ["*"]))).alias("value"))


def reader_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None, group_prefix: str | None = None
) -> dict[str, str]:
    """Options for a ``kafka`` stream; ``max_offsets`` caps the records of one micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options
