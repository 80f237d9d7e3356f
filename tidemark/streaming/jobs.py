"""Streaming operators and sinks on Structured Streaming."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.ordered import latest
from .state import KeyedState


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None,
    max_bytes: str | None = None, event_time: str | None = None,
) -> DataFrame:
    """Stream over the files of a table; ``max_files`` or ``max_bytes`` caps one micro-batch.

    ``event_time`` casts a zone-less timestamp so it can carry a watermark.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    df = reader.load(path)
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")) if event_time else df


def table_glob(path: str) -> str:
    """The path as a glob, which a file stream accepts for a single file and a directory alike."""
    head, last = path[:-1], path[-1]
    return f"{head}[{last}]"


def tumbling_counts(stream: DataFrame, at: str, width: str, lateness: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per window and key; with append output a window appears once the watermark passed it."""
    counted = (
        stream.withWatermark(at, lateness)
        .groupBy(F.window(at, width), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n")


def deduplicated(stream: DataFrame, keys: Sequence[str], at: str, lateness: str) -> DataFrame:
    """First row per key; keys are forgotten once the watermark passed them, which bounds the state."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))


def with_static(stream: DataFrame, static: DataFrame, on, how: str = "left") -> DataFrame:
    return stream.join(static, on, how)


def joined_streams(left: DataFrame, right: DataFrame, condition, how: str = "inner") -> DataFrame:
    """Both sides need watermarks and the condition a time bound, so old state can go."""
    return left.join(right, condition, how)


def joined_within(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, seconds: int, lateness: str
) -> DataFrame:
    """Inner join of two streams: same key, right row 0 to ``seconds`` after the left row.

    Both sides also meet on a time unit of that length (a left row in its own
    and the next one), so the rows of a hot key spread over the state
    partitions by time.
    """
    unit = F.floor(F.unix_micros(left_at) / (seconds * 1_000_000)).cast("long")
    a = left.withWatermark(left_at, lateness).withColumn("_unit", F.explode(F.array(unit, unit + 1)))
    b = right.withWatermark(right_at, lateness).withColumn(
        "_unit", F.floor(F.unix_micros(right_at) / (seconds * 1_000_000)).cast("long")
    )
    a, b = a.alias("a"), b.alias("b")
    match = F.expr(f"b.`{right_at}` >= a.`{left_at}` AND b.`{right_at}` <= a.`{left_at}` + INTERVAL {int(seconds)} SECONDS")
    for k in [*keys, "_unit"]:
        match = match & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    kept = [F.col(f"a.{c}") for c in left.columns] + [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return a.join(b, match, "inner").select(*kept)


def _start(writer, continuous: str | None) -> StreamingQuery:
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def to_files(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append to a Parquet directory: everything available, or every interval with ``every``."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path)
    return _start(writer.queryName(name) if name else writer, every)


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    return _start(stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint), every)


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def run_until(query: StreamingQuery, done: Callable[[], bool], wait: float = 120.0) -> StreamingQuery:
    """Let an interval query go on until ``done`` holds, then stop it."""
    until = time.monotonic() + wait
    try:
        while not done():
            if not query.isActive:
                query.awaitTermination()
                raise RuntimeError("the query ended before it was done")
            if time.monotonic() > until:
                raise TimeoutError("the query did not get done")
            time.sleep(0.1)
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def keyed_sink(path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Idempotent upsert sink: the newest row per key, kept up in key buckets.

    A batch rewrites the buckets of its keys, a replayed one nothing, and a read
    meets one version of each bucket however many batches there were.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        def change(tables: Mapping[str, DataFrame | None], rows: DataFrame) -> dict[str, DataFrame]:
            held = tables["rows"]
            # Of equal rows the later batch wins.
            rows = rows.withColumn("_batch", F.lit(batch_id).cast("long"))
            both = rows if held is None else held.unionByName(rows, allowMissingColumns=True)
            return {"rows": latest(both, keys, [*[F.desc(c) for c in order], F.desc("_batch")])}

        KeyedState(batch.sparkSession, path, keys, buckets).apply(batch, batch_id, change, ["rows"])

    return work


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    return KeyedState(spark, path, keys, buckets).read("rows").drop("_batch")


def append_flows(flows: Mapping[str, DataFrame], path: str, state_dir: str) -> dict[str, StreamingQuery]:
    """Several sources into one target, each with its own checkpoint and folder of the shared root."""
    return {
        name: to_files(stream, f"{path}/flow={name}", f"{state_dir}/{name}", name=None) for name, stream in flows.items()
    }


def read_flows(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """All rows of the flows, each folder read by its own log, so that files of failed attempts are left out."""
    parts = [spark.read.parquet(f"{path}/flow={name}").withColumn("flow", F.lit(name)) for name in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_lag(progress: DataFrame, landed: int) -> DataFrame:
    """Progress with the rows of the source that no batch has read yet, after each batch; ``landed`` rows are there in all."""
    before = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)  # one row per batch
    return progress.withColumn("lag_rows", F.lit(landed) - F.sum("input_rows").over(before))


class ProgressLog(StreamingQueryListener):
    """Every micro-batch of the queries that run inside the block; Spark itself remembers only the last hundred."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.ended = spark, {}, set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])
        row = (p["batchId"], p["numInputRows"], late, p.get("eventTime", {}).get("watermark"))
        self.rows.setdefault(p["runId"], []).append(row)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def progress_rows(self, query: StreamingQuery, wait: float = 60.0) -> DataFrame:
        """One row per micro-batch of a finished query with its rows, rows dropped as late, and watermark.

        Events arrive after the query has ended, its end last.
        """
        until = time.monotonic() + wait
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError("the end of the query was not reported")
            time.sleep(0.05)
        rows = self.rows.get(str(query.runId), [])
        return self.spark.createDataFrame(rows, "batch_id long, input_rows long, late_rows long, watermark string")
