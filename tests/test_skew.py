"""Skew-safe operators give the plain result when one key holds most rows."""

import pytest
from pyspark.sql import Window, functions as F

from conftest import rows
from tidemark.operators import cdc, distribution, ordered, skew
from tidemark.operators import relational as rel
from tidemark.sources import files


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds 70% of 4000 rows; its timeline is long, all others are short."""
    return spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 90 + 1).alias("k"),
        F.col("id").alias("seq"), (F.hash("id") % 3).alias("v"), (F.col("id") % 17 == 0).alias("gone"),
    ).cache()


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(80).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


def test_hot_keys_are_found(skewed):
    hot = skew.hot_hashes(skewed, ["k"], 0.1)
    assert len(hot) == 1
    assert skewed.filter(skew.is_hot(["k"], hot)).select("k").distinct().collect()[0]["k"] == 0


def test_no_hot_keys(skewed):
    assert skew.hot_hashes(skewed, ["seq"], 0.1) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(skewed, dim, how):
    assert rows(skew.join_salted(skewed, dim, ["k"], how, salts=8)) == rows(skewed.join(dim, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fully_salted_join(skewed, dim, how):
    assert rows(skew.join_salted_full(skewed, dim, ["k"], how, 4)) == rows(skewed.join(dim, ["k"], how))


def test_salted_join_refuses_outer(skewed, dim):
    with pytest.raises(ValueError):
        skew.join_salted(skewed, dim, ["k"], "full")


def test_salt_spreads_copies(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    salts = copies.withColumn("s", skew.row_salt(copies, 8)).select("s").distinct().count()
    assert salts > 1


def test_salted_aggregates(skewed):
    measures = {"n": ("count", "*"), "total": ("sum", "seq"), "mean": ("avg", "seq"), "low": ("min", "seq"), "high": ("max", "seq")}
    plain = skewed.groupBy("k").agg(
        F.count(F.lit(1)), F.sum("seq"), F.avg("seq"), F.min("seq"), F.max("seq")
    )
    assert rows(skew.agg_salted(skewed, ["k"], measures)) == rows(plain)


def test_salted_average_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 4.0), (2, None)], "k int, v double")
    assert rows(skew.agg_salted(df, ["k"], {"m": ("avg", "v")})) == [(1, 4.0), (2, None)]


@pytest.mark.parametrize("fn", ["count_distinct", "percentile"])
def test_salted_aggregate_refuses(skewed, fn):
    with pytest.raises(ValueError):
        skew.agg_salted(skewed, ["k"], {"x": (fn, "seq")})


def test_neighbours_across_slices(skewed):
    w = Window.partitionBy("k").orderBy("seq")
    want = skewed.select("k", "seq", F.lag("seq").over(w).alias("p"), F.lead("seq").over(w).alias("n"))
    linked = ordered.neighbours(skewed, ["k"], ["seq"], ["seq"], slices=7)
    got = linked.select("k", "seq", F.col("_prev.seq").alias("p"), F.col("_next.seq").alias("n"))
    assert rows(got) == rows(want)


def test_hot_timeline_is_cut(skewed):
    slicing = ordered.plan_slices(skewed, ["k"], "seq", slices=7)
    sizes = slicing.add(skewed, "s").filter("k = 0").groupBy("s").count().collect()
    assert len(sizes) == 7
    assert max(r["count"] for r in sizes) < 2 * 2800 / 7


def test_strings_with_a_long_common_start_are_cut(skewed):
    named = skewed.withColumn("seq", F.concat(F.lit("event/of/the/year/2024-"), F.lpad(F.col("seq").cast("string"), 9, "0")))
    slicing = ordered.plan_slices(named, ["k"], "seq", slices=7)
    sizes = slicing.add(named, "s").filter("k = 0").groupBy("s").count().collect()
    assert max(r["count"] for r in sizes) < 2 * 2800 / 7
    w = Window.partitionBy("k").orderBy("seq")
    want = named.select("k", "seq", F.lag("seq").over(w).alias("p"), F.lead("seq").over(w).alias("n"))
    linked = ordered.neighbours(named, ["k"], ["seq"], ["seq"])
    assert rows(linked.select("k", "seq", F.col("_prev.seq").alias("p"), F.col("_next.seq").alias("n"))) == rows(want)


def test_threshold_and_pieces_follow_the_shuffle_tasks(spark, skewed):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        shares = skew.hot_shares(skewed, ["k"])
        counts = skew.pieces(skewed, shares)
        assert len(shares) == 28  # the others hold 1.1 % each, more than half of one task's part
        task = 4000 / 100
        salted = skewed.withColumn("s", skew.row_salt(skewed, skew.n_pieces(["k"], counts), ["seq"]))
        assert max(r["count"] for r in salted.groupBy("k", "s").count().collect()) < 1.5 * task
        slicing = ordered.plan_slices(skewed, ["k"], "seq")
        sliced = slicing.add(skewed, "s").groupBy("k", "s").count().collect()
        assert max(r["count"] for r in sliced) < task
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "double"])
def test_positions_follow_the_order(spark, kind):
    days = spark.range(1, 400).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    value = F.col("id").cast("double") if kind == "double" else F.col("d").cast(kind)
    df = days.select(value.alias("c"))
    got = [r["p"] for r in df.withColumn("p", ordered.position(df, "c")).orderBy("c").collect()]
    assert got == sorted(got)


def naive_scd2(df):
    """Row by row on the driver."""
    out, by_key = [], {}
    for r in df.collect():
        by_key.setdefault(r["k"], []).append(r)
    for k, events in by_key.items():
        open_row = None
        for r in sorted(events, key=lambda r: r["seq"]):
            if r["gone"]:
                if open_row:
                    out.append((*open_row, r["seq"]))
                open_row = None
            elif open_row is None or open_row[1] != r["v"]:
                if open_row:
                    out.append((*open_row, r["seq"]))
                open_row = (k, r["v"], r["seq"])
        if open_row:
            out.append((*open_row, None))
    return sorted(out, key=repr)


def test_scd2_of_a_hot_key(skewed):
    got = cdc.scd2(skewed, ["k"], "seq", deletes="gone", except_cols=["gone"])
    assert rows(got) == naive_scd2(skewed)


@pytest.fixture
def many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    yield 2000
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_key_of_less_than_a_sketch_can_tell(spark, many_tasks):
    """0.04 % of the rows are more than half of one of 2,000 parts: counted exactly, and split."""
    n = 100_000
    rows_ = spark.range(n).select(F.when(F.col("id") < 40, -1).otherwise(F.col("id")).alias("k"), "id")
    shares = skew.hot_shares(rows_, ["k"])
    assert list(shares.values()) == [40 / n]
    slicing = ordered.plan_slices(rows_, ["k"], "id")
    sizes = slicing.add(rows_.filter("k = -1"), "s").groupBy("s").count().collect()
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) <= 25


def test_ties_of_one_sequence_value_leave_before_the_shuffle(spark):
    """A hot key whose rows all have one sequence: every task sends one row of it, and the highest tie wins."""
    n = 4000
    df = spark.range(n).repartition(6).select(
        F.when(F.col("id") % 4 != 0, 0).otherwise(F.col("id")).alias("k"), F.lit(7).alias("seq"), F.col("id").alias("tie"),
        F.concat(F.lit("v"), "id").alias("v"),
    )
    got = cdc.scd2(df, ["k"], "seq", except_cols=["tie"], tie=["tie"])
    want = {0: n - 1} | {i: i for i in range(4, n, 4)}
    assert rows(got) == sorted(((k, f"v{t}", 7, None) for k, t in want.items()), key=repr)
    slicing = ordered.plan_slices(df, ["k"], "seq")
    assert list(slicing.cuts) == [df.filter("k = 0").select(skew.key_hash(["k"])).first()[0]]
    before_shuffle = ordered.latest(df.filter("k = 0"), ["k", "seq"], [F.desc("tie")])
    text = before_shuffle._jdf.queryExecution().executedPlan().toString()
    assert text.index("WindowGroupLimit") < text.rindex("Exchange") or "Partial" in text


@pytest.mark.parametrize("second", ["number", "text"])
def test_one_first_value_is_cut_by_the_second(spark, second):
    """All rows of the hot key share the first order column, so slices follow both."""
    n = 3000
    name = F.col("id") if second == "number" else F.lpad(F.col("id").cast("string"), 6, "0")
    df = spark.range(n).select(F.when(F.col("id") % 10 != 0, 0).otherwise(1).alias("k"), F.lit(1.5).alias("at"), name.alias("n"))
    slicing = ordered.plan_slices(df, ["k"], ["at", "n"], slices=8)
    sizes = slicing.add(df.filter("k = 0"), "s").groupBy("s").count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 0.3 * n
    got = ordered.neighbours(df, ["k"], ["at", "n"], ["n"], slicing=slicing)
    plain = Window.partitionBy("k").orderBy("at", "n")
    want = df.select("k", "n", F.lag("n").over(plain), F.lead("n").over(plain))
    assert rows(got.select("k", "n", "_prev.n", "_next.n")) == rows(want)


def test_hot_buckets_are_written_by_several_tasks(spark, folder):
    df = spark.range(8000).select(F.when(F.col("id") % 10 < 6, 3).otherwise(F.col("id")).alias("k"), "id").repartition(5)
    spread = files.bucket_spread(df, 8, ["k"])
    hot = df.filter("k = 3").select(F.pmod(F.hash("k"), F.lit(8))).first()[0]
    assert spread[hot] >= 3 and sorted(spread.values())[-2] == 1
    name = "spread_" + folder.rsplit("-", 1)[-1]
    files.write_bucketed(df, name, folder, 8, ["k"])
    try:
        per_file = spark.read.table(name).groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.max((F.col("k") == 3).cast("int")).alias("hot"))
        sizes = [(r["n"], r["hot"]) for r in per_file.collect()]
        assert sum(n for n, _ in sizes) == 8000 and sum(h for _, h in sizes) == spread[hot]
        assert max(n for n, _ in sizes) < 8000 / 8 * 2.2
        joined = spark.read.table(name).join(spark.read.table(name).select("k").distinct(), "k")
        assert joined.count() == 8000
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_scd1_of_a_hot_key(skewed):
    newest = {}
    for r in skewed.collect():
        if r["k"] not in newest or newest[r["k"]]["seq"] < r["seq"]:
            newest[r["k"]] = r
    want = sorted(((r["k"], r["v"]) for r in newest.values() if not r["gone"]), key=repr)
    assert rows(cdc.scd1(skewed, ["k"], "seq", deletes="gone", except_cols=["gone"])) == want


def test_latest_limits_before_the_shuffle(skewed):
    from conftest import plan

    text = plan(ordered.latest(skewed, ["k"], [F.desc("seq")]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_repartition_by_key_spreads_hot_rows(skewed):
    even = distribution.repartition_key(skewed, ["k"], 8, share=0.1)
    sizes = even.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 2800


def test_range_join_equals_plain(spark):
    fact = spark.range(600).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("at"))
    periods = spark.sql("""SELECT * FROM VALUES
        (0L, TIMESTAMP_NTZ '1970-01-05', TIMESTAMP_NTZ '1970-07-01', 1), (0L, TIMESTAMP_NTZ '1970-07-02', NULL, 2),
        (1L, TIMESTAMP_NTZ '1970-02-01', TIMESTAMP_NTZ '1970-02-01', 3), (2L, TIMESTAMP_NTZ '1969-01-01', NULL, 4)
        AS t(k, s, e, p)""")
    got = rel.join_range(fact, periods, ["k"], "at", "s", "e", "month", open_until="1980-01-01").select("k", "at", "p")
    want = fact.alias("f").join(
        periods.alias("q"), F.expr("f.k = q.k AND at >= s AND at <= coalesce(e, TIMESTAMP_NTZ '1980-01-01')")
    ).select("f.k", "at", "p")
    assert rows(got) == rows(want)
    assert got.count() > 0
