"""Layout jobs; each query proves that the rows are the same and the files better."""

from pyspark.sql import functions as F

from ..operators import layout as lay
from ..session import materialize
from ..sources.files import write_partitioned
from .registry import query

CONTENT = """SELECT count(*) AS n, sum(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total FROM orders"""


def _content(df):
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def _many_files(t, name, parts=24):
    path = t.scratch(name)
    t.orders.repartition(parts).write.parquet(path)
    return path


@query("file_stats", """
    SELECT 'o_orderstatus=' || o_orderstatus AS "partition", true AS has_files, true AS consistent FROM orders GROUP BY 1""")
def file_stats(t):
    path = t.scratch("stats")
    write_partitioned(t.orders, path, ["o_orderstatus"])
    s = lay.file_stats(t.spark, path)
    same = F.abs(F.col("avg_bytes") * F.col("files") - F.col("bytes")) < 1
    return s.select("partition", (F.col("files") > 0).alias("has_files"), same.alias("consistent"))


@query("column_file_stats", """
    SELECT o_orderstatus AS status, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
        min(o_totalprice) AS low, max(o_totalprice) AS high, min(o_orderpriority) AS first_priority,
        max(o_orderdate) AS newest, count(*) FILTER (o_custkey % 7 = 0) AS nulls FROM orders GROUP BY 1""")
def column_file_stats(t):
    path = t.scratch("colstats")
    some = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("some")
    t.orders.select("*", some).repartition("o_orderstatus", "o_orderkey").write.partitionBy("o_orderstatus").parquet(path)
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate", "some"]
    stats = lay.column_file_stats(t.spark, path, columns)
    return stats.groupBy(F.regexp_extract("file", "o_orderstatus=([^/]+)/", 1).alias("status")).agg(
        F.sum("rows").alias("n"), F.min("min_o_orderkey").alias("first_key"), F.max("max_o_orderkey").alias("last_key"),
        F.min("min_o_totalprice").alias("low"), F.max("max_o_totalprice").alias("high"),
        F.min("min_o_orderpriority").alias("first_priority"), F.max("max_o_orderdate").alias("newest"),
        F.sum("nulls_some").alias("nulls"),
    )


@query("skip_plan", """
    SELECT o_orderkey, o_totalprice, 'far' AS found FROM orders WHERE o_totalprice BETWEEN 50000 AND 60000
    UNION ALL SELECT o_orderkey, o_totalprice, 'new' FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, -o_totalprice, 'new' FROM orders WHERE o_totalprice > 200000""")
def skip_plan(t):
    path = t.scratch("sorted")
    prices = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    prices.repartitionByRange(16, "o_totalprice", "o_orderkey").write.parquet(path)
    far = lay.read_skipping(t.spark, path, {"o_totalprice": (50000, 60000)}).withColumn("found", F.lit("far"))
    far = materialize(far.select("o_orderkey", "o_totalprice", "found"), "far")
    # Files that come later are read into the kept statistics by the next call.
    prices.withColumn("o_totalprice", -F.col("o_totalprice")).write.mode("append").parquet(path)
    new = lay.read_skipping(t.spark, path, {"o_totalprice": (200000.01, None), "o_orderstatus": ("F", "F")})
    gone = lay.read_skipping(t.spark, path, {"o_totalprice": (None, -200000.01)})
    return far.unionAll(new.unionAll(gone).select("o_orderkey", "o_totalprice", F.lit("new")))


@query("partition_advice", """
    SELECT 'o_orderstatus' AS "column", true AS advised FROM orders GROUP BY 1 UNION ALL SELECT 'o_orderkey', false""")
def partition_advice(t):
    """The measured bytes of the table against a floor of a tenth of them for each directory."""
    path = _many_files(t, "advice", 4)
    size = lay.table_bytes(t.spark, path)
    table = t.spark.read.parquet(path)
    return lay.partition_advice(table, ["o_orderstatus", "o_orderkey"], size, size // 10).select("column", "advised")


@query("compact", f"""
    SELECT *, true AS fewer, 0 AS again FROM ({CONTENT})""")
def compact(t):
    path = _many_files(t, "compact")
    target = max(lay.table_bytes(t.spark, path) // 3, 1)
    first = lay.compact(t.spark, path, target)
    again = lay.compact(t.spark, path, target)
    fewer = first["files_added"] < first["files_removed"]
    return _content(t.spark.read.parquet(path)).withColumn("fewer", F.lit(fewer)).withColumn(
        "again", F.lit(again["files_removed"])
    )


@query("compact_partition", """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, o_orderstatus = 'F' AS merged
    FROM orders GROUP BY 1""")
def compact_partition(t):
    path = t.scratch("compact-part")
    t.orders.repartition(12).write.partitionBy("o_orderstatus").parquet(path)
    lay.compact(t.spark, path, 64 * lay.MB, folder_like="o_orderstatus=F")
    df = t.spark.read.parquet(path)
    per = df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.countDistinct("_metadata.file_path").alias("files"),
    )
    return per.select("o_orderstatus", "n", "total", (F.col("files") < 12).alias("merged"))


@query("target_file_size", """
    SELECT o_orderkey, round(CASE WHEN o_totalprice / 10 < 2560 THEN 256.0 WHEN o_totalprice / 10 > 10000 THEN 1024.0
      ELSE 256.0 + (o_totalprice / 10 - 2560) / 7440.0 * 768.0 END, 6) AS target_mb FROM orders""")
def target_file_size(t):
    return t.orders.select("o_orderkey", F.round(lay.target_file_mb(F.col("o_totalprice") / 10), 6).alias("target_mb"))


@query("write_right_sized", """
    SELECT o_orderstatus, count(*) AS n, true AS few FROM orders GROUP BY 1""")
def write_right_sized(t):
    path = t.scratch("rightsized")
    lay.write_right_sized(t.orders.repartition(16), path, ["o_orderstatus"])
    per = t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_metadata.file_path").alias("files"), F.sum(F.lit(64)).alias("bytes")
    )
    few = F.col("files") <= 2 + F.col("bytes") / F.lit(64 * lay.MB)
    return per.select("o_orderstatus", "n", few.alias("few"))


@query("zorder_rewrite", f"SELECT *, true AS skips_more FROM ({CONTENT})")
def zorder_rewrite(t):
    path = _many_files(t, "zorder", 16)
    ranges = {"o_custkey": (100, 120), "o_totalprice": (20000, 40000)}

    def kept():
        stats = lay.column_file_stats(t.spark, path, list(ranges))
        return lay.skip_plan(stats, ranges).count()

    before = kept()
    lay.zorder_rewrite(t.spark, path, ["o_custkey", "o_totalprice"], 16)
    return _content(t.spark.read.parquet(path)).withColumn("skips_more", F.lit(kept() < before))


@query("cluster_rewrite", f"""
    SELECT 2 * n AS n, 2 * keys AS keys, round(2 * total, 2) AS total, true AS only_new, true AS full_all FROM ({CONTENT})""")
def cluster_rewrite(t):
    path = _many_files(t, "cluster", 8)
    keys = ["o_orderstatus", "o_totalprice"]
    lay.cluster_rewrite(t.spark, path, keys, 4)
    done = lay.file_count(t.spark, path)
    t.orders.repartition(3).write.mode("append").parquet(path)
    second = lay.cluster_rewrite(t.spark, path, keys, 2)
    total = lay.file_count(t.spark, path)
    third = lay.cluster_rewrite(t.spark, path, ["o_custkey"], 4, full=True)
    return (
        _content(t.spark.read.parquet(path))
        .withColumn("only_new", F.lit(second["files_removed"] == 3 and done <= 4))
        .withColumn("full_all", F.lit(third["files_removed"] == total))
    )


@query("purge_deletes", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def purge_deletes(t):
    path = t.scratch("purge")
    t.orders.repartitionByRange(12, "o_custkey", "o_orderkey").write.parquet(path)
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    lay.purge_deletes(t.spark, path, gone, ["o_custkey"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_totalprice")
