"""Layout jobs keep every row and survive an interrupted exchange."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import layout as lay
from tidemark.sources import swap


@pytest.fixture
def small_files(tables, folder):
    tables.orders.repartition(20).write.parquet(folder)
    return folder


def content(spark, path):
    return rows(spark.read.parquet(path).select("o_orderkey", "o_totalprice"))


def test_compaction_is_idempotent(spark, tables, small_files):
    want = rows(tables.orders.select("o_orderkey", "o_totalprice"))
    first = lay.compact(spark, small_files, 10 * lay.MB)
    assert first == {"files_removed": 20, "files_added": 1}
    assert lay.compact(spark, small_files, 10 * lay.MB) == {"files_removed": 0, "files_added": 0}
    assert content(spark, small_files) == want


def test_big_files_stay(spark, tables, small_files):
    tables.orders.repartition(1).write.mode("append").parquet(small_files)
    sizes = {r["path"]: r["length"] for r in lay._listing(spark, small_files).collect()}
    big = max(sizes, key=sizes.get)
    lay.compact(spark, small_files, sizes[big])
    assert big in {r["path"] for r in lay._listing(spark, small_files).collect()}


def test_compaction_of_one_partition(spark, tables, folder):
    tables.orders.repartition(6).write.partitionBy("o_orderstatus").parquet(folder)
    before = {r["partition"]: r["files"] for r in lay.file_stats(spark, folder).collect()}
    lay.compact(spark, folder, 10 * lay.MB, folder_like="o_orderstatus=F")
    after = {r["partition"]: r["files"] for r in lay.file_stats(spark, folder).collect()}
    assert after.pop("o_orderstatus=F") == 1
    before.pop("o_orderstatus=F")
    assert after == before
    assert spark.read.parquet(folder).count() == tables.orders.count()


def test_compaction_of_all_partitions(spark, tables, folder):
    tables.orders.repartition(6).write.partitionBy("o_orderstatus").parquet(folder)
    lay.compact(spark, folder, 10 * lay.MB)
    assert {r["files"] for r in lay.file_stats(spark, folder).collect()} == {1}
    got = spark.read.parquet(folder).groupBy("o_orderstatus").count()
    assert rows(got) == rows(tables.orders.groupBy("o_orderstatus").count())


@pytest.mark.parametrize("months", [("01",), ("01", "02")])
def test_partition_values_keep_their_spelling(spark, folder, months):
    for m in months:
        for i in range(3):
            spark.range(5).coalesce(1).write.parquet(f"{folder}/part{i}-{m}")
            os.makedirs(f"{folder}/t/month={m}", exist_ok=True)
            for name in os.listdir(f"{folder}/part{i}-{m}"):
                if name.endswith(".parquet"):
                    os.link(f"{folder}/part{i}-{m}/{name}", f"{folder}/t/month={m}/{i}-{name}")
    lay.compact(spark, f"{folder}/t", 10 * lay.MB)
    stats = {r["partition"]: r["files"] for r in lay.file_stats(spark, f"{folder}/t").collect()}
    assert stats == {f"month={m}": 1 for m in months}
    assert spark.read.parquet(f"{folder}/t").count() == 15 * len(months)


def test_interrupted_exchange_is_finished(spark, tables, small_files):
    want = rows(tables.orders.select("o_orderkey", "o_totalprice"))
    paths = [r["path"] for r in lay._listing(spark, small_files).collect()]
    stage = swap.staging(small_files)
    spark.read.parquet(*paths).repartition(2).write.parquet(stage)
    with open(f"{small_files}/_swap-x.json", "w") as f:
        json.dump({"stage": stage, "inputs": paths, "mark": ""}, f)
    os.remove(paths[0].removeprefix("file:"))  # the crash came after the first delete
    assert swap.recover(spark, small_files) == 1
    assert content(spark, small_files) == want
    assert swap.recover(spark, small_files) == 0


def test_unfinished_staging_is_dropped(spark, tables, small_files):
    tables.orders.write.parquet(swap.staging(small_files))
    assert swap.recover(spark, small_files) == 0
    assert not [n for n in os.listdir(small_files) if n.startswith("_stage")]


def test_zorder_narrows_both_columns(spark, tables):
    df = tables.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
    ranges = {"l_partkey": (10, 30), "l_suppkey": (1, 2)}

    def kept(frame, path):
        frame.write.parquet(path)
        stats = lay.column_file_stats(spark, path, list(ranges))
        return lay.skip_plan(stats, ranges).count()

    from tidemark.session import scratch_path

    plain = kept(df.repartition(16), scratch_path(spark, "plain"))
    curved = lay.zorder(df, ["l_partkey", "l_suppkey"], 16)
    assert kept(curved, scratch_path(spark, "curved")) < plain == 16
    assert rows(curved.groupBy("l_partkey", "l_suppkey", "l_quantity").count()) == rows(
        df.groupBy("l_partkey", "l_suppkey", "l_quantity").count()
    )


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 2), (4, 2)])
def test_hilbert_visits_every_cell_by_single_steps(spark, dims, bits):
    """All cells once, each one step in one direction from the last."""
    names = [f"c{i}" for i in range(dims)]
    side = 1 << bits
    cells = spark.range(side**dims).select(*[(F.floor(F.col("id") / side**i) % side).cast("long").alias(n) for i, n in enumerate(names)])
    axes = [f"a{n}" for n in names]
    placed = lay.along_hilbert(cells.withColumns(dict(zip(axes, map(F.col, names)))), axes, "h", bits)
    got = sorted((r["h"], tuple(r[n] for n in names)) for r in placed.collect())
    assert [h for h, _ in got] == list(range(side**dims))
    steps = [sum(abs(a - b) for a, b in zip(x, y)) for (_, x), (_, y) in zip(got, got[1:])]
    assert set(steps) == {1}


@pytest.mark.parametrize("n_files", [8, 64])
def test_hilbert_skips_more_than_interleaving(spark, tables, n_files):
    """Boxes over both columns: fewer files on average, whose ranges come from the curve's partitions."""
    df = spark.range(60_000).select((F.xxhash64("id") % 1000).cast("double").alias("x"), (F.xxhash64("id", F.lit(1)) % 1000).cast("double").alias("y"))

    def touched(curve):
        laid = lay.zorder(df, ["x", "y"], n_files, curve=curve)
        boxes = laid.groupBy(F.spark_partition_id()).agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).collect()
        hits = 0
        for i in range(-9, 10):
            for j in range(-9, 10):
                hits += sum(b[1] <= i * 100 + 60 and b[2] >= i * 100 and b[3] <= j * 100 + 60 and b[4] >= j * 100 for b in boxes)
        return hits, len(boxes)

    (hilbert, a), (z, b) = touched("hilbert"), touched("z")
    assert a >= 0.8 * n_files and hilbert < z


def test_bits_follow_the_files():
    assert lay.curve_bits(2, 8) == 4 and lay.curve_bits(2, 800) == 7 and lay.curve_bits(4, 800) == 4
    assert lay.curve_bits(1, 10**9) == 12 and lay.curve_bits(6, 10**9) * 6 <= 62


def test_bins(spark):
    """No bin is empty, shared by folders or filled further once it is full."""
    sizes = {"a": [5, 9, 40, 41, 3, 60], "b": [99, 98], "c": [1] * 7}
    listed = [(f"{f}/{i}", n, f) for f, ns in sizes.items() for i, n in enumerate(ns)]
    got = lay.plan_bins(spark.createDataFrame(listed, "path string, length long, folder string"), 100).collect()
    bins = {}
    for r in got:
        bins.setdefault(r["bin"], []).append(r)
    assert sorted(bins) == list(range(len(bins))) and len(got) == len(listed)
    for held in bins.values():
        assert len({r["folder"] for r in held}) == 1
        assert sum(r["length"] for r in held) - max(r["length"] for r in held) < 100
    assert len({r["bin"] for r in got if r["folder"] == "c"}) == 1


def test_every_bin_is_one_file(spark, tables, folder):
    tables.orders.repartition(10).write.partitionBy("o_orderstatus").parquet(folder)
    small = lay._listing(spark, folder)
    target = small.agg(F.sum("length")).first()[0] // 6
    bins = lay.plan_bins(small, target).select("bin").distinct().count()
    report = lay.compact(spark, folder, target)
    assert report["files_added"] == bins and rows(spark.read.parquet(folder).select("o_orderkey")) == rows(tables.orders.select("o_orderkey"))


def test_zorder_splits_one_hot_value(spark):
    df = spark.range(20000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), "id")
    sizes = lay.zorder(df, ["a", "b"], 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 8000


def test_zorder_keeps_nulls_first(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (2, "b")], "x int, s string")
    z = {(r["x"], r["s"]): r["z"] for r in lay.with_zvalue(df, ["x", "s"], "z").collect()}
    assert z[(None, "a")] <= z[(2, "b")] and z[(1, None)] <= z[(2, "b")]


def test_skip_plan_keeps_files_without_statistics(spark):
    stats = spark.createDataFrame([("a", None, None), ("b", 1, 5), ("c", 6, 9)], "file string, min_x int, max_x int")
    assert [r["file"] for r in lay.skip_plan(stats, {"x": (7, None)}).collect()] == ["a", "c"]
    assert [r["file"] for r in lay.skip_plan(stats, {"x": (None, 5)}).collect()] == ["a", "b"]


def test_clustering_keys(spark, small_files):
    with pytest.raises(ValueError):
        lay.cluster_rewrite(spark, small_files, ["a", "b", "c", "d", "e"], 4)


def test_clustering_by_a_nested_field(spark, tables, folder):
    nested = tables.orders.select("o_orderkey", F.struct("o_totalprice", "o_orderstatus").alias("info"))
    nested.repartition(5).write.parquet(folder)
    lay.cluster_rewrite(spark, folder, ["info.o_orderstatus", "o_orderkey"], 3)
    assert rows(spark.read.parquet(folder)) == rows(nested)


def test_purge_touches_only_affected_files(spark, tables, folder):
    tables.orders.repartitionByRange(8, "o_orderkey").write.parquet(folder)
    before = {r["path"] for r in lay._listing(spark, folder).collect()}
    gone = spark.createDataFrame([(0,), (1,)], "o_orderkey long")
    report = lay.purge_deletes(spark, folder, gone, ["o_orderkey"])
    assert report["files_removed"] == 1
    assert len(before & {r["path"] for r in lay._listing(spark, folder).collect()}) == len(before) - 1
    assert spark.read.parquet(folder).filter("o_orderkey < 2").count() == 0


def test_purge_keeps_the_marks_of_layout_jobs(spark, tables, folder):
    tables.orders.repartition(6).write.parquet(folder)
    lay.cluster_rewrite(spark, folder, ["o_custkey"], 3)
    tables.orders.limit(100).coalesce(1).write.mode("append").parquet(folder)
    gone = tables.orders.orderBy("o_orderkey").limit(20).select("o_orderkey")
    lay.purge_deletes(spark, folder, gone, ["o_orderkey"])
    again = lay.cluster_rewrite(spark, folder, ["o_custkey"], 1)
    assert again["files_removed"] == 1, "only the file that was never clustered"


@pytest.mark.parametrize("gb, mb", [(1, 256), (2560, 256), (6280, 640), (10000, 1024), (50000, 1024)])
def test_target_size(gb, mb):
    assert lay.target_file_bytes(gb * lay.GB) == mb * lay.MB


def test_string_cuts_follow_all_values(spark):
    names = spark.range(6400).select(F.concat(F.lit("a/long/common/start/"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("c"))
    per = lay.with_zvalue(names.repartition(7), ["c"], "_z").groupBy("_z").count().collect()
    assert len(per) == 32
    assert max(r["count"] for r in per) < 2 * 6400 / 32


# --- footer statistics -------------------------------------------------------------

MIXED = "i int, l long, d double, s string, b boolean, day date, at timestamp_ntz, x decimal(12,2), n struct<k: int>, a array<int>"


def mixed(spark, n=400):
    return spark.range(n).selectExpr(
        "cast(id as int) i", "id * 3000000000 l", "id / 7 d", "'é' || lpad(id, 4, '0') s", "id % 2 = 0 b",
        "date_add(date'1960-01-01', cast(id as int)) day", "timestamp_ntz'1969-12-31 00:00:00' + make_interval(0, 0, 0, 0, id) at",
        "cast(id - 100 as decimal(12,2)) / 4 x", "if(id % 3 = 0, null, named_struct('k', cast(id as int))) n", "array(1) a",
    ).selectExpr(*[f"cast({c} as {k}) {c}" for c, k in (p.split(" ", 1) for p in MIXED.split(", "))])


def test_footers_of_all_types(spark, folder):
    mixed(spark).repartitionByRange(4, "i").write.parquet(folder)
    names = ["i", "l", "d", "s", "b", "day", "at", "x", "n.k"]
    got = lay.column_file_stats(spark, folder, names)
    df = spark.read.parquet(folder)
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in names:
        parts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    assert rows(got.drop("file")) == rows(df.groupBy("_metadata.file_path").agg(*parts).drop("file_path"))


def test_statistics_read_no_column(spark, tables, folder):
    """All bytes before the footer are wiped: a scan fails, the statistics do not."""
    tables.orders.repartition(3).write.parquet(folder)
    want = rows(tables.orders.agg(F.min("o_orderkey"), F.max("o_totalprice"), F.count("*")))
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "r+b") as f:
                data = f.read()
                footer = int.from_bytes(data[-8:-4], "little") + 8
                f.seek(4)
                f.write(bytes(len(data) - footer - 4))
            crc = f"{folder}/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    stats = lay.column_file_stats(spark, folder, ["o_orderkey", "o_totalprice"])
    assert rows(stats.agg(F.min("min_o_orderkey"), F.max("max_o_totalprice"), F.sum("rows"))) == want
    with pytest.raises(Exception):
        spark.read.parquet(folder).agg(F.sum("o_orderkey")).collect()


def kept_files(spark, folder):
    return {r["file"] for r in spark.read.parquet(f"{folder}/_stats").select("file").collect()}


def test_kept_statistics_follow_the_files(spark, tables, folder):
    tables.orders.repartition(3).write.parquet(folder)
    lay.column_file_stats(spark, folder, ["o_orderkey"]).collect()
    first = kept_files(spark, folder)
    parts = len(os.listdir(f"{folder}/_stats"))
    lay.column_file_stats(spark, folder, ["o_custkey"]).collect()
    assert len(os.listdir(f"{folder}/_stats")) == parts, "nothing new, nothing read"
    extra = tables.orders.limit(50).withColumn("added", F.lit(5))
    extra.coalesce(1).write.mode("append").parquet(folder)
    os.remove(min(first).removeprefix("file:"))
    stats = lay.column_file_stats(spark, folder, ["o_orderkey", "added"])
    assert {r["file"] for r in stats.collect()} == kept_files(spark, folder) - {min(first)}
    assert stats.filter("min_added = 5").count() == 1
    assert stats.filter("min_added IS NULL").count() == 2
    assert "row_group" not in spark.read.parquet(folder).columns


def test_skipping_reads_only_the_kept_files(spark, folder):
    mixed(spark).repartitionByRange(8, "i").write.parquet(folder)
    found = lay.read_skipping(spark, folder, {"x": (-5, -2), "b": (True, True)})
    assert rows(found.select("i")) == [(i,) for i in range(80, 93, 2)]
    assert len(found.inputFiles()) <= 2
    assert lay.read_skipping(spark, folder, {"i": (4000, None)}).collect() == []


def test_files_of_nulls_are_skipped(spark, folder):
    spark.range(10).select("id", F.lit(None).cast("int").alias("v")).coalesce(1).write.parquet(folder)
    spark.range(10, 20).select("id", F.lit(1).alias("v")).coalesce(1).write.mode("append").parquet(folder)
    stats = lay.column_file_stats(spark, folder, ["v"])
    assert rows(stats.select("min_v", "max_v", "nulls_v")) == [(1, 1, 0), (None, None, 10)]
    assert lay.skip_plan(stats, {"v": (0, None)}).count() == 1
    assert lay.skip_plan(stats, {"v": (None, None)}).count() == 2
