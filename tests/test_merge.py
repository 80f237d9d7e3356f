"""Merges, slice rewrites and versions on literal rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import index
from tidemark.operators import merge as m
from tidemark.operators import rewrite as rw
from tidemark.operators import versions as v
from tidemark.operators.ordered import latest


STOCK = "bin string, lot int, grams long, sealed boolean"


@pytest.fixture
def target(spark):
    """Stock by bin and lot; one lot without a number, and the same bin in several lots."""
    held = [("A4", 11, 500, True), ("A4", 12, 0, False), ("B1", 11, None, True), ("B1", None, 70, False), ("C9", 30, 9, None)]
    return spark.createDataFrame(held, STOCK)


@pytest.fixture
def feed(spark):
    """Weighings in any order: A4/11 four times with a tie for the newest, B1/11 twice, C9/31 new and twice, B1 without a lot."""
    seen = [
        ("A4", 11, 480, True, 7), ("A4", 11, 470, False, 9), ("A4", 11, 465, True, 9), ("A4", 11, 999, True, 1),
        ("B1", 11, 88, None, 3), ("B1", 11, 77, True, 2), ("B1", None, 71, False, 5),
        ("C9", 31, 5, True, 4), ("C9", 31, 6, True, 6),
    ]
    return spark.createDataFrame(seen, STOCK + ", scan int")


def test_dedup_then_upsert(target, feed):
    newest = latest(feed, ["bin", "lot"], [F.desc("scan"), F.asc("grams")]).drop("scan")
    assert rows(m.upsert(target, newest, ["bin", "lot"])) == sorted([
        ("A4", 11, 465, True), ("A4", 12, 0, False), ("B1", 11, 88, None), ("B1", None, 70, False), ("B1", None, 71, False),
        ("C9", 30, 9, None), ("C9", 31, 6, True),
    ], key=repr)


def test_several_matches_are_refused(target, feed):
    """Only keys the target has count: C9/31 is repeated, too, but new."""
    with pytest.raises(m.MultipleMatchError, match="A4|B1"):
        m.upsert(target, feed.drop("scan"), ["bin", "lot"])
    assert rows(m.repeated_matches(target, feed, ["bin", "lot"])) == [("A4", 11, 4), ("B1", 11, 2)]
    assert m.repeated_matches(target, feed.filter("bin = 'C9'"), ["bin", "lot"]).isEmpty()


def test_duplicates_without_a_match_are_fine(target, feed):
    assert m.upsert(target, feed.filter("bin = 'C9'").drop("scan"), ["bin", "lot"]).count() == 7


def test_a_random_source_is_read_once(spark):
    """Matched and new rows come from one draw: no key is lost or doubled."""
    t = spark.range(0, 400, 2).select("id", F.lit(0.0).alias("v"))
    s = spark.range(400).filter(F.rand() < 0.5).select("id", F.rand().alias("v"))
    got = m.upsert(t, s, ["id"]).select("id").collect()
    assert len(got) == len({r["id"] for r in got}) and {r["id"] for r in got} >= set(range(0, 400, 2))


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    s = spark.createDataFrame([(None, "c"), (1, "d")], "id int, v string")
    assert rows(m.upsert(t, s, ["id"])) == sorted([(None, "a"), (None, "c"), (1, "d")], key=repr)


def test_null_key_rows_count_as_not_matched_by_source(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    s = spark.createDataFrame([(1, "d")], "id int, v string")
    assert rows(m.merge(t, s, ["id"], not_matched_by_source=[m.Delete()])) == [(1, "b")]


def test_unknown_condition_is_no(spark, target):
    s = spark.createDataFrame([("A4", 12, None, None)], STOCK)
    clauses = [m.Delete("s.grams > 5"), m.Update({"sealed": "true"}, "s.grams IS NULL")]
    assert ("A4", 12, 0, True) in rows(m.merge(target, s, ["bin", "lot"], matched=clauses))


def test_first_clause_wins(target, spark):
    s = spark.createDataFrame([("C9", 30, 1, True)], STOCK)
    got = m.merge(target, s, ["bin", "lot"], matched=[m.Update({"grams": "t.grams + s.grams"}), m.Delete()])
    assert ("C9", 30, 10, None) in rows(got) and got.count() == 5


def naive_merge(target, source):
    by_key = {s["id"]: s for s in source}
    out = []
    for t in target:
        s = by_key.get(t["id"])
        if s is None:
            if t["amount"] >= 0:
                out.append((t["id"], t["amount"]))
        elif s["amount"] > t["amount"]:
            out.append((t["id"], s["amount"]))
        elif s["amount"] != 0:
            out.append((t["id"], t["amount"]))
    have = {t["id"] for t in target}
    out += [(s["id"], s["amount"]) for s in source if s["id"] not in have and s["amount"] > 0]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_merge(spark, seed):
    rng = random.Random(seed)
    t = spark.createDataFrame([(rng.randrange(60), rng.randrange(-5, 6)) for _ in range(150)], "id int, amount int")
    ids = rng.sample(range(90), 50)
    s = spark.createDataFrame([(i, rng.randrange(-5, 6)) for i in ids], "id int, amount int")
    got = m.merge(
        t, s, ["id"],
        matched=[m.Update({"amount": "s.amount"}, "s.amount > t.amount"), m.Delete("s.amount = 0")],
        not_matched=[m.Insert(when="s.amount > 0")],
        not_matched_by_source=[m.Delete("t.amount < 0")],
    )
    assert rows(got) == naive_merge(t.collect(), s.collect())


def test_replace_where(spark, target):
    slice_ = spark.createDataFrame([("B1", 40, 4, True), ("B1", 41, None, None)], STOCK)
    got = rows(m.replace_where(target, slice_, "bin = 'B1'"))
    assert got == sorted([("A4", 11, 500, True), ("A4", 12, 0, False), ("B1", 40, 4, True), ("B1", 41, None, None), ("C9", 30, 9, None)], key=repr)
    with pytest.raises(m.SliceViolation):
        m.replace_where(target, slice_, "grams > 0")


def test_replace_where_keeps_unknown_rows(spark):
    t = spark.createDataFrame([(1, None), (2, "a")], "id int, tier string")
    new = spark.createDataFrame([(3, "a")], "id int, tier string")
    assert rows(m.replace_where(t, new, "tier = 'a'")) == [(1, None), (3, "a")]


def test_partition_overwrite_excludes_predicate(target, folder):
    with pytest.raises(ValueError):
        m.overwrite_partitions(target, folder, ["bin"], where="bin = 'A4'")


def test_staged_overwrite_may_read_its_own_table(spark, target, folder):
    target.write.parquet(folder)
    m.staged_overwrite(m.delete_where(spark.read.parquet(folder), "bin < 'C'"), folder)
    assert rows(spark.read.parquet(folder)) == [("C9", 30, 9, None)]


def test_old_rows_stay_gone_after_a_crash(spark, target, folder, monkeypatch):
    """An overwrite that stopped after naming what it replaces is finished by the next one, not after it."""
    target.write.parquet(folder)
    with monkeypatch.context() as patch:
        patch.setattr(m.swap, "_finish", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            m.staged_overwrite(target.withColumn("grams", F.lit(1)), folder)
    m.staged_overwrite(target.withColumn("grams", F.lit(2)), folder)
    m.swap.recover(spark, folder)
    assert [r["grams"] for r in spark.read.parquet(folder).collect()] == [2] * 5


# --- rewrites of touched files -----------------------------------------------------


def names(spark, folder):
    return set(m.swap.data_files(spark, folder))


@pytest.fixture
def lines(tables, folder):
    """Lineitems in 12 files by order, and one more file of the same orders that ranges cannot tell apart."""
    keys = tables.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    keys.filter("l_linenumber < 3").repartitionByRange(12, "l_orderkey", "l_linenumber").write.parquet(folder)
    keys.filter("l_linenumber >= 3").repartition(2, "l_linenumber").write.mode("append").parquet(folder)
    return folder


def test_merge_rewrites_touched_files_only(spark, lines):
    before, table = names(spark, lines), spark.read.parquet(lines)
    source = table.filter("l_linenumber < 3").orderBy(*table.columns).limit(1)
    source = source.withColumn("l_quantity", F.lit(-1.0)).unionAll(
        spark.createDataFrame([(-5, 1, -2.0, 0.0), (None, 1, -3.0, 0.0)], source.schema)
    )
    want = rows(m.upsert(table, source, ["l_orderkey", "l_linenumber"], guard=False))
    report = rw.merge_path(spark, lines, source, ["l_orderkey", "l_linenumber"])
    assert report["files_removed"] == 1 and report["files_kept"] == len(before) - 1
    assert len(names(spark, lines) & before) == len(before) - 1
    assert rows(spark.read.parquet(lines)) == want
    # New rows alone leave every file in place; so does a second lookup of the kept index.
    now = names(spark, lines)
    rw.merge_path(spark, lines, spark.createDataFrame([(-9, 1, 0.0, 0.0)], source.schema), ["l_orderkey", "l_linenumber"])
    assert now < names(spark, lines) and spark.read.parquet(lines).count() == len(want) + 1


def test_merge_path_deletes_and_refuses(spark, lines):
    key = spark.read.parquet(lines).filter("l_linenumber = 1").first()["l_orderkey"]
    twice = spark.createDataFrame([(key, 1, 1.0, 0.0), (key, 1, 2.0, 0.0)], spark.read.parquet(lines).schema)
    before = names(spark, lines)
    with pytest.raises(m.MultipleMatchError):
        rw.merge_path(spark, lines, twice, ["l_orderkey", "l_linenumber"])
    assert names(spark, lines) == before, "a refused merge changes nothing"
    rw.merge_path(spark, lines, twice.limit(1), ["l_orderkey", "l_linenumber"], [m.Delete()], [])
    assert spark.read.parquet(lines).filter(F.col("l_orderkey") == key).filter("l_linenumber = 1").isEmpty()


def test_update_and_delete_by_condition(spark, lines):
    before, table = names(spark, lines), spark.read.parquet(lines)
    cut = table.approxQuantile("l_orderkey", [0.02], 0.0)[0]
    condition = f"l_orderkey <= {int(cut)} AND l_linenumber < 3"
    want = rows(m.update_where(table, condition, {"l_quantity": "l_quantity * 2"}))
    report = rw.update_path(spark, lines, condition, {"l_quantity": "l_quantity * 2"})
    assert report["files_removed"] < 4 and rows(spark.read.parquet(lines)) == want
    want = rows(m.delete_where(spark.read.parquet(lines), condition))
    rw.delete_path(spark, lines, condition)
    assert rows(spark.read.parquet(lines)) == want
    assert len(names(spark, lines) & before) >= len(before) - 4
    assert rw.delete_path(spark, lines, "l_orderkey < -100")["files_removed"] == 0


def test_partitioned_merge_with_new_columns(spark, tables, folder):
    tables.customer.repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(folder)
    before = names(spark, folder)
    source = tables.customer.filter("c_nationkey = 4").withColumn("note", F.lit("seen"))
    rw.merge_path(spark, folder, source, ["c_custkey"], evolve=True)
    assert {n for n in before if "c_nationkey=4/" not in n} <= names(spark, folder)
    got = spark.read.option("mergeSchema", "true").parquet(folder)
    assert got.filter("note = 'seen'").count() == source.count() and got.count() == tables.customer.count()


def test_index_finds_every_key(spark, folder, monkeypatch):
    """Ranges, filters and the join beyond the limit name the same files; strings and numbers, runs smaller than files."""
    rng = random.Random(8)
    data = [(rng.randrange(10**6), f"k{rng.randrange(500)}", rng.choice([None, 1])) for _ in range(3000)]
    spark.createDataFrame(data, "n long, s string, x int").repartition(9).write.parquet(folder)
    held = spark.read.parquet(folder).select("n", "s", F.col("_metadata.file_path").alias("f")).collect()
    for pick in (["n"], ["s"], ["s", "n"]):
        some = rng.sample(data, 3)
        wanted = spark.createDataFrame(some, "n int, s string, x int")
        keys = {tuple(getattr(r, k) if hasattr(r, k) else r["nsx".index(k)] for k in pick) for r in some}
        want = {r["f"].replace("file:///", "file:/") for r in held if tuple(r[k] for k in pick) in keys}
        near = set(index.files_with(spark, folder, wanted, pick))
        assert want <= near and set(index.files_holding(spark, folder, wanted, pick)) == want
        if pick == ["n"]:
            assert len(near) <= len(want) + 1
        with monkeypatch.context() as patch:
            patch.setattr(index, "LOOKUP", 1)
            assert set(index.files_with(spark, folder, wanted, pick)) == want
    assert index.files_with(spark, folder, wanted.limit(0), ["n"]) == []


def test_filters_have_no_misses():
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(2**63), 2**63, 5000, dtype=np.int64)
    held = index.bloom(hashes)
    assert index.may_hold(held, hashes).all()
    assert index.may_hold(held, rng.integers(-(2**63), 2**63, 20000, dtype=np.int64)).mean() < 0.02


def test_two_writers(spark, lines):
    """The second is refused while the first goes on, and what the first staged stays."""
    with m.swap.owned(spark, lines):
        stage = m.swap.staging(lines)
        spark.range(3).write.parquet(stage)
        with pytest.raises(m.swap.OwnedError, match=spark.sparkContext.applicationId):
            rw.delete_path(spark, lines, "l_linenumber = 1")
        with pytest.raises(m.swap.OwnedError):
            m.staged_overwrite(spark.range(1).toDF("l_orderkey"), lines)
        assert m.swap.exists(spark, stage)
    before = spark.read.parquet(lines).count()
    assert rw.delete_path(spark, lines, "l_linenumber = 1")["files_removed"] > 0
    assert 0 < spark.read.parquet(lines).count() < before
    assert not m.swap.exists(spark, stage), "what a dead job staged goes with the next one"


def test_release_after_a_dead_owner(spark, target, folder):
    target.write.parquet(folder)
    with open(f"{folder}/_owner", "w") as f:
        f.write("{}")
    with pytest.raises(m.swap.OwnedError):
        m.staged_overwrite(target, folder)
    m.swap.release(spark, folder)
    m.staged_overwrite(target.limit(0), folder)
    assert spark.read.parquet(folder).isEmpty()


@pytest.fixture
def log(spark):
    data = [
        (1, 1, "2024-01-01 10:00:00", "I", 10.0), (2, 1, "2024-01-01 10:00:00", "I", 20.0),
        (3, 2, "2024-01-02 10:00:00", "I", 30.0), (1, 3, "2024-01-03 10:00:00", "U", 11.0),
        (2, 4, "2024-01-04 10:00:00", "D", None),
    ]
    return spark.createDataFrame(data, "id int, _seq int, _ts string, _op string, amount double").withColumn(
        "_ts", F.col("_ts").cast("timestamp")
    )


def test_versions(log):
    assert rows(v.as_of(log, ["id"], 3)) == [(1, 11.0), (2, 20.0), (3, 30.0)]
    assert rows(v.as_of(log, ["id"], 4)) == [(1, 11.0), (3, 30.0)]
    assert rows(v.as_of(log, ["id"], ts="2024-01-02 12:00:00")) == [(1, 10.0), (2, 20.0), (3, 30.0)]


@pytest.mark.parametrize("version", [0, 5])
def test_unknown_version(log, version):
    with pytest.raises(v.UnknownVersion):
        v.as_of(log, ["id"], version)


def test_time_before_the_first_commit(log):
    with pytest.raises(v.UnknownVersion):
        v.as_of(log, ["id"], ts="2020-01-01 00:00:00")


def test_restore_keeps_history(log):
    back = v.restore(log, ["id"], 3, ts="2024-01-05 00:00:00")
    assert rows(v.as_of(back, ["id"], 5)) == rows(v.as_of(log, ["id"], 3))
    assert rows(v.as_of(back, ["id"], 4)) == rows(v.as_of(log, ["id"], 4))


def test_recover_deleted(log):
    assert rows(v.recover_deleted(log, ["id"], 3)) == [(2, 20.0)]


def test_net_changes(log):
    assert rows(v.change_feed(log, ["id"], 1, 4)) == sorted(
        [(3, 30.0, "insert"), (1, 10.0, "update_preimage"), (1, 11.0, "update_postimage"), (2, 20.0, "delete")], key=repr
    )


def test_changes_by_commit(log):
    feed = v.change_feed_by_commit(log, ["id"], 2, 4)
    assert rows(feed.drop("_commit_timestamp")) == sorted(
        [(3, 30.0, "insert", 2), (1, 10.0, "update_preimage", 3), (1, 11.0, "update_postimage", 3), (2, 20.0, "delete", 4)], key=repr
    )
    times = feed.select("_commit_version", F.date_format("_commit_timestamp", "yyyy-MM-dd HH:mm")).distinct()
    assert rows(times) == [(2, "2024-01-02 10:00"), (3, "2024-01-03 10:00"), (4, "2024-01-04 10:00")]
    assert "_commit_timestamp" not in v.change_feed_by_commit(log.drop("_ts"), ["id"], 2, 4).columns


def test_expired_history(log):
    kept, dropped = v.expire_history(log, ["id"], 3, 4)
    assert rows(v.as_of(kept, ["id"], 3, kept_from=3)) == rows(v.as_of(log, ["id"], 3))
    assert rows(dropped.select("id", "_seq")) == [(1, 1)]
    with pytest.raises(v.UnknownVersion):
        v.as_of(kept, ["id"], 2, kept_from=3)
    with pytest.raises(ValueError):
        v.expire_history(log, ["id"], 4, 4, min_keep=2)
