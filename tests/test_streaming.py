"""Streaming jobs driven by landed files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import cdc as batch_cdc
from tidemark.streaming import cdc, jobs
from tidemark.streaming.state import KeyedState


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def ticks(spark):
    def make(*rows_):
        return spark.createDataFrame(list(rows_), "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))

    return make


def test_late_rows_are_dropped_and_counted(spark, ticks, folder):
    seen = []
    for batch in (
        ticks((1, "2024-01-01 10:00:00"), (2, "2024-01-01 12:00:00")),
        ticks((3, "2024-01-01 10:01:00"), (4, "2024-01-01 12:01:00")),
    ):
        land(batch, f"{folder}/in")
        stream = jobs.file_stream(spark, f"{folder}/in", batch.schema, event_time="at")
        counted = jobs.tumbling_counts(stream, "at", "5 minutes", "10 minutes")
        with jobs.ProgressLog(spark) as log:
            seen.append(log.progress_rows(jobs.finish(jobs.to_files(counted, f"{folder}/out", f"{folder}/state"))))
    closed = spark.read.parquet(f"{folder}/out")
    assert [(str(r["window_start"])[11:16], r["n"]) for r in closed.collect()] == [("10:00", 1)]
    assert seen[1].agg(F.sum("late_rows")).first()[0] == 1


def test_progress_of_more_batches_than_spark_remembers(spark, folder):
    spark.range(0, 130, 1, 130).write.parquet(f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", spark.range(1).schema, max_files=1)
    with jobs.ProgressLog(spark) as log:
        seen = log.progress_rows(jobs.finish(jobs.for_each_batch(stream, lambda batch, n: batch.count(), f"{folder}/state")))
    assert seen.agg(F.sum("input_rows")).first()[0] == 130 and seen.count() >= 130


def test_append_needs_a_watermark(spark, ticks, folder):
    batch = ticks((1, "2024-01-01 10:00:00"))
    land(batch, f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", batch.schema, event_time="at")
    with pytest.raises(Exception, match="append|Append"):
        jobs.to_files(stream.groupBy("id").count(), f"{folder}/out", f"{folder}/state")


def test_restart_and_full_reload(spark, ticks, folder):
    for n in range(2):
        batch = ticks((n, "2024-01-01 10:00:00"))
        land(batch, f"{folder}/in")
        stream = jobs.file_stream(spark, f"{folder}/in", batch.schema)
        jobs.finish(jobs.to_files(stream, f"{folder}/out", f"{folder}/state"))
    assert spark.read.parquet(f"{folder}/out").count() == 2
    jobs.finish(jobs.to_files(stream, f"{folder}/again", f"{folder}/other-state"))
    assert spark.read.parquet(f"{folder}/again").count() == 2


def test_keyed_sink_replay(spark, folder):
    sink = jobs.keyed_sink(folder, ["k"], ["seq"], 4)
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    second = spark.createDataFrame([(1, 3, "d"), (2, 0, "late")], first.schema)
    for batch, number in ((first, 0), (second, 1), (first, 0), (second, 1)):
        sink(batch, number)
    assert rows(jobs.read_keyed(spark, folder, ["k"], 4)) == [(1, 3, "d"), (2, 1, "c")]
    wider = spark.createDataFrame([(3, 1, "e", 5), (1, 3, "same order, later batch", 6)], "k int, seq int, v string, w int")
    sink(wider, 2)
    assert rows(jobs.read_keyed(spark, folder, ["k"], 4).filter("w IS NOT NULL")) == rows(wider)


def test_reads_do_not_grow_with_the_batches(spark, folder):
    sink = jobs.keyed_sink(folder, ["k"], ["seq"], 4)
    for n in range(12):
        sink(spark.range(n * 3, n * 3 + 9).select(F.col("id").alias("k"), F.lit(n).alias("seq")), n)
    df = jobs.read_keyed(spark, folder, ["k"], 4)
    assert len(df.inputFiles()) <= 4 and df.count() == 42
    assert len(os.listdir(f"{folder}/_maps")) <= 4, "two maps and their checksums"
    held = sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)
    assert held <= 8, "buckets no map names are gone"


FEED = "k string, at int, op string, tier string, noise int, tie int"


def random_feed(spark, seed, batches, truncates=False):
    """Changes of few keys in mixed order: late rows, equal sequences, deletes and re-inserts."""
    rnd = random.Random(seed)
    ops = ["put", "put", "put", "drop"] + (["wipe"] if truncates else [])
    out = []
    for b in range(batches):
        # Sequences stay apart by key and op, so that ties are settled by the tie column alone.
        out.append([
            (f"k{rnd.randrange(25)}", rnd.randrange(60), rnd.choice(ops), rnd.choice("abc"), rnd.randrange(9), b * 1000 + i)
            for i in range(rnd.randrange(1, 40))
        ])
    wiped = rnd.sample(range(60, 70), 3)
    for b, rows_ in enumerate(out):
        out[b] = [(None, wiped[b % 3] - 40, op, *r) if op == "wipe" else (k, at, op, *r) for k, at, op, *r in rows_]
    return [spark.createDataFrame(r, FEED) for r in out]


@pytest.mark.parametrize("truncates", [False, True])
def test_current_state_by_batches(spark, folder, truncates):
    options = {"deletes": "op = 'drop'", "except_cols": ["op", "tie"], "tie": ["tie"]}
    if truncates:
        options["truncates"] = "op = 'wipe'"
    state = KeyedState(spark, folder, ["k"], 6)
    seen = None
    for n, batch in enumerate(random_feed(spark, 7 + truncates, 5, truncates)):
        done = cdc.apply_current(state, batch, n, "at", **options)
        assert not done["skipped"] and cdc.apply_current(state, batch, n, "at", **options)["skipped"]
        seen = batch if seen is None else seen.unionAll(batch)
        assert rows(cdc.current(state)) == rows(batch_cdc.scd1(seen, ["k"], "at", **options))


def test_history_by_batches(spark, folder):
    options = {"deletes": "op = 'drop'", "track_except": ["noise"], "except_cols": ["op", "tie"], "tie": ["tie"]}
    state = KeyedState(spark, folder, ["k"], 6)
    seen = None
    for n, batch in enumerate(random_feed(spark, 3, 4)):
        cdc.apply_history(state, batch, n, "at", **options)
        seen = batch if seen is None else seen.unionAll(batch)
        assert rows(cdc.history(state)) == rows(batch_cdc.scd2(seen, ["k"], "at", **options))


def test_a_batch_reads_the_buckets_of_its_keys_only(spark, folder, monkeypatch):
    state = KeyedState(spark, folder, ["k"], 32)
    many = spark.range(400).selectExpr("concat('k', id) k", "1 at", "'put' op", "'a' tier", "0 noise", "0 tie")
    options = {"except_cols": ["op", "tie"], "tie": ["tie"]}
    assert cdc.apply_history(state, many, 0, "at", **options) == {"batch": 0, "skipped": False, "read": 0, "written": 64}
    asked = []
    read = KeyedState.read
    monkeypatch.setattr(KeyedState, "read", lambda s, t, b=None: asked.append((t, tuple(b))) or read(s, t, b))
    two = spark.createDataFrame([("k5", 2, "put", "b", 1, 1), ("k5", 3, "put", "c", 1, 1), ("k77", 0, "put", "z", 1, 1)], FEED)
    done = cdc.apply_history(state, two, 1, "at", **options)
    buckets = tuple(sorted(r[0] for r in two.select(state.bucket()).distinct().collect()))
    assert len(buckets) <= 2 and done["read"] == done["written"] == 2 * len(buckets)
    assert asked == [("changes", buckets), ("dimension", buckets)]
    versions = state.newest()["versions"]["dimension"]
    assert {int(b) for b, v in versions.items() if v == 1} == set(buckets) and len(versions) == 32


def test_a_failed_batch_leaves_the_state_as_it_was(spark, folder, monkeypatch):
    state = KeyedState(spark, folder, ["k"], 3)
    first, second = random_feed(spark, 5, 2)
    options = {"except_cols": ["op", "tie"], "tie": ["tie"]}
    cdc.apply_current(state, first, 0, "at", **options)
    before = rows(cdc.current(state))
    with monkeypatch.context() as patch:
        patch.setattr(KeyedState, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            cdc.apply_current(state, second, 1, "at", **options)
    assert rows(cdc.current(state)) == before
    cdc.apply_current(state, second, 1, "at", **options)
    assert rows(cdc.current(state)) == rows(batch_cdc.scd1(first.unionAll(second), ["k"], "at", **options))


def test_streams_into_dimensions(spark, folder):
    """One file a batch, reports of every batch, and a second run that finds nothing new."""
    for batch in random_feed(spark, 11, 3):
        land(batch, f"{folder}/in")
    schema, reports = batch.schema, []
    options = {"deletes": "op = 'drop'", "except_cols": ["op", "tie"], "tie": ["tie"]}
    for _ in range(2):
        stream = jobs.file_stream(spark, f"{folder}/in", schema, max_files=1)
        jobs.finish(cdc.keep_history(stream, f"{folder}/dim", f"{folder}/cp", ["k"], "at", 4, reports.append, **options))
    assert [r["batch"] for r in reports] == [0, 1, 2] and reports[0]["read"] == 0 < reports[1]["read"]
    want = batch_cdc.scd2(spark.read.parquet(f"{folder}/in"), ["k"], "at", **options)
    assert rows(cdc.read_history(spark, f"{folder}/dim", ["k"], 4)) == rows(want)


def test_timed_join_equals_batch(spark, tables, folder):
    ev = tables.events
    left = ev.filter("event_type = 'view'").select(F.col("event_id").alias("a"), "user_id", F.col("ts").alias("t1"))
    right = ev.filter("event_type = 'click'").select(F.col("event_id").alias("b"), "user_id", F.col("ts").alias("t2"))
    want = left.join(right, "user_id").filter("t2 >= t1 AND t2 <= t1 + INTERVAL 2 HOURS").select("a", "b")
    for name, df in (("l", left), ("r", right)):
        df.repartition(2).write.parquet(f"{folder}/{name}")
    streams = [
        jobs.file_stream(spark, f"{folder}/{n}", df.schema, event_time=c) for n, df, c in (("l", left, "t1"), ("r", right, "t2"))
    ]
    joined = jobs.joined_within(*streams, ["user_id"], "t1", "t2", 7200, "1 day").select("a", "b")
    jobs.finish(jobs.to_files(joined, f"{folder}/out", f"{folder}/state"))
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(want)
    assert want.count() > 0


def test_message_options():
    from tidemark.sources import messages

    got = messages.reader_options("h:1", "t", "earliest", 500)
    assert got["maxOffsetsPerTrigger"] == "500" and got["startingOffsets"] == "earliest"


def test_federated_options():
    from tidemark.sources import database

    got = database.scan_options("jdbc:x", "t", split=database.Split("id", 0, 100, 4))
    assert got["pushDownPredicate"] == "true" and got["numPartitions"] == "4" and got["partitionColumn"] == "id"


def test_scratch_paths_are_fresh(spark):
    from tidemark import session

    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_scratch_folders(spark):
    from tidemark import session

    with session.scratch_folder(spark, "stage") as outer:
        with session.scratch_folder(spark, "part") as inner:
            table = session.materialize(spark.range(3), "t")
        assert inner.startswith(outer + "/") and table.inputFiles()[0].removeprefix("file://").startswith(inner + "/")
        assert session.scratch_path(spark, "x").rsplit("/", 1)[0] == outer
    assert not session.scratch_path(spark, "x").startswith(outer)


def test_message_round_trip(spark):
    from tidemark.sources import messages

    df = spark.createDataFrame([(1, "a")], "user_id int, event string")
    sent = messages.encode(df, "user_id").select(F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("t").alias("topic"))
    back = messages.decode(sent, "user_id INT, event STRING", keep=["topic"])
    assert rows(back) == [(1, "a", "t")]


def test_static_join_plan(spark, tables, folder):
    land(tables.events, f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", tables.events.schema)
    joined = jobs.with_static(stream, tables.customer.withColumnRenamed("c_custkey", "user_id"), "user_id")
    jobs.finish(jobs.to_files(joined.select("event_id"), f"{folder}/out", f"{folder}/state"))
    assert spark.read.parquet(f"{folder}/out").count() == tables.events.count()


class FakeSession:
    """Just the parts of a session the scratch folder depends on."""

    def __init__(self, master, configured=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: configured or default)})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_no_machine_folder_on_a_cluster():
    from tidemark import session

    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn"))
    assert session.shared_dir(FakeSession("yarn", "hdfs://x/cp/")) == "hdfs://x/cp"
    assert session.shared_dir(FakeSession("local[2]")) == session.shared_dir(FakeSession("local[2]"))
