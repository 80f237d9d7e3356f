"""Merges, updates, deletes and slice overwrites."""

from pyspark.sql import functions as F

from ..operators import merge as m
from ..operators import rewrite
from ..session import materialize
from ..sources import files, swap
from .registry import query

SOURCE = """s AS (SELECT c_custkey + 300 AS c_custkey, c_name || '*' AS c_name, c_nationkey, round(c_acctbal + 10, 2) AS c_acctbal,
    c_mktsegment FROM customer)"""


def _source(t):
    return t.customer.select(
        (F.col("c_custkey") + 300).alias("c_custkey"), F.concat("c_name", F.lit("*")).alias("c_name"), "c_nationkey",
        F.round(F.col("c_acctbal") + 10, 2).alias("c_acctbal"), "c_mktsegment",
    )


@query("merge_upsert", f"""
    WITH {SOURCE}
    SELECT * FROM s UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s)""")
def merge_upsert(t):
    return m.upsert(t.customer, _source(t), ["c_custkey"])


@query("merge_conditional", f"""
    WITH {SOURCE}
    SELECT t.c_custkey, CASE WHEN s.c_acctbal > t.c_acctbal THEN s.c_name ELSE t.c_name END AS c_name, t.c_nationkey,
           CASE WHEN s.c_acctbal > t.c_acctbal THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment
    FROM customer t LEFT JOIN s ON t.c_custkey = s.c_custkey
    WHERE NOT coalesce(s.c_mktsegment = 'MACHINERY', false)
    UNION ALL
    SELECT c_custkey, c_name, NULL, 0.0, c_mktsegment FROM s
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer) AND c_acctbal > 0""")
def merge_conditional(t):
    return m.merge(
        t.customer, _source(t), ["c_custkey"],
        matched=[
            m.Delete("s.c_mktsegment = 'MACHINERY'"),
            m.Update({"c_name": "s.c_name", "c_acctbal": "s.c_acctbal"}, "s.c_acctbal > t.c_acctbal"),
        ],
        not_matched=[
            m.Insert({"c_custkey": "s.c_custkey", "c_name": "s.c_name", "c_acctbal": "0.0", "c_mktsegment": "s.c_mktsegment"},
                     "s.c_acctbal > 0")
        ],
    )


@query("merge_not_matched_by_source", f"""
    WITH {SOURCE}
    SELECT t.c_custkey, coalesce(s.c_name, t.c_name) AS c_name, t.c_nationkey,
           CASE WHEN s.c_custkey IS NULL THEN 0.0 ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment
    FROM customer t LEFT JOIN s ON t.c_custkey = s.c_custkey
    WHERE s.c_custkey IS NOT NULL OR t.c_acctbal >= 0""")
def merge_not_matched_by_source(t):
    return m.merge(
        t.customer, _source(t), ["c_custkey"],
        matched=[m.Update({"c_name": "s.c_name"})],
        not_matched_by_source=[m.Delete("t.c_acctbal < 0"), m.Update({"c_acctbal": "0.0"})],
    )


@query("merge_multi_match_guard", """
    SELECT o_custkey AS c_custkey, count(*) AS source_rows, true AS refused FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1 HAVING count(*) > 1""")
def merge_multi_match_guard(t):
    """The keys that make the merge of orders into some customers ambiguous, and whether it was refused."""
    target = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal")
    source = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"))
    try:
        m.upsert(target, source, ["c_custkey"])
        refused = False
    except m.MultipleMatchError:
        refused = True
    return m.repeated_matches(target, source, ["c_custkey"]).withColumn("refused", F.lit(refused))


def _by_nation(t, name):
    path = t.scratch(name)
    t.customer.repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(path)
    return path, swap.data_files(t.spark, path)


def _with_touch(t, path, before):
    """Rows of the table and whether their file was written since ``before``."""
    uri = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    kept = uri.isin([n.replace("file:///", "file:/") for n in before])
    return t.spark.read.parquet(path).select(*t.customer.columns, (~kept).alias("rewritten"))


@query("merge_pruned", """
    WITH s AS (
      SELECT c_custkey, c_name || '*' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
        WHERE c_nationkey IN (3, 7) AND c_custkey % 4 = 0
      UNION ALL SELECT s_suppkey + 10000000, s_name, s_nationkey, s_acctbal, 'NEW' FROM supplier WHERE s_nationkey >= 20),
    hit AS (SELECT DISTINCT c_nationkey FROM s WHERE c_mktsegment <> 'NEW')
    SELECT *, c_nationkey IN (SELECT c_nationkey FROM hit) AS rewritten FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s)
    UNION ALL SELECT *, true FROM s""")
def merge_pruned(t):
    """A small feed into a table of many files: only files that hold its keys are rewritten."""
    path, before = _by_nation(t, "merge-path")
    changed = t.customer.filter("c_nationkey IN (3, 7) AND c_custkey % 4 = 0").withColumn("c_name", F.concat("c_name", F.lit("*")))
    new = t.supplier.filter("s_nationkey >= 20").select(
        F.col("s_suppkey") + 10_000_000, "s_name", "s_nationkey", "s_acctbal", F.lit("NEW")
    )
    rewrite.merge_path(t.spark, path, changed.unionAll(new), ["c_custkey"])
    return _with_touch(t, path, before)


@query("update_path", """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey IN (1, 2) AND c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
        c_mktsegment, c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_nationkey IN (1, 2) AND c_acctbal < 0) AS rewritten
    FROM customer""")
def update_path(t):
    path, before = _by_nation(t, "update-path")
    rewrite.update_path(t.spark, path, "c_nationkey IN (1, 2) AND c_acctbal < 0", {"c_acctbal": "0.0"})
    return _with_touch(t, path, before)


@query("delete_path", """
    SELECT *, c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) AS rewritten
    FROM customer WHERE c_acctbal <= 9900""")
def delete_path(t):
    path, before = _by_nation(t, "delete-path")
    rewrite.delete_path(t.spark, path, "c_acctbal > 9900")
    return _with_touch(t, path, before)


@query("merge_evolve", """
    WITH s AS (SELECT s_suppkey AS c_custkey, s_name AS c_name, 'x' || s_suppkey AS channel FROM supplier)
    SELECT t.c_custkey, coalesce(s.c_name, t.c_name) AS c_name, t.c_acctbal, s.channel
    FROM (SELECT c_custkey, c_name, c_acctbal FROM customer) t LEFT JOIN s ON t.c_custkey = s.c_custkey
    UNION ALL SELECT s.c_custkey, s.c_name, NULL, s.channel FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def merge_evolve(t):
    source = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.concat(F.lit("x"), F.col("s_suppkey").cast("string")).alias("channel"),
    )
    return m.upsert(t.customer.select("c_custkey", "c_name", "c_acctbal"), source, ["c_custkey"], evolve=True)


@query("update_where", """
    SELECT o_orderkey, CASE WHEN o_orderkey IN (5, 7, 11) OR o_totalprice BETWEEN 1000 AND 2000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey IN (5, 7, 11) OR o_totalprice BETWEEN 1000 AND 2000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def update_where(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return m.update_where(
        df, "o_orderkey IN (5, 7, 11) OR o_totalprice BETWEEN 1000 AND 2000",
        {"o_orderstatus": "'X'", "o_totalprice": "o_totalprice * 2"},
    )


@query("delete_where", """
    SELECT event_id, kind FROM (SELECT event_id, nullif(event_type, 'view') AS kind FROM events)
    WHERE kind IS NULL OR kind <> 'error'""")
def delete_where(t):
    df = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return m.delete_where(df, "kind = 'error'")


@query("delete_in_subquery", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def delete_in_subquery(t):
    poor = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return m.delete_in(t.orders.select("o_orderkey", "o_custkey"), poor, ["o_custkey"])


@query("insert_overwrite", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def insert_overwrite(t):
    path = t.scratch("overwrite")
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.parquet(path)
    m.staged_overwrite(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    return t.spark.read.parquet(path)


@query("replace_where", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT s_suppkey, s_name, 'BUILDING' FROM supplier""")
def replace_where(t):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment")
    )
    return m.replace_where(t.customer.select("c_custkey", "c_name", "c_mktsegment"), rows, "c_mktsegment = 'BUILDING'")


@query("insert_rows", """
    SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
    UNION ALL SELECT -1, 'literal'""")
def insert_rows(t):
    path = t.scratch("insert")
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.parquet(path)
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).write.mode("append").parquet(path)
    t.spark.createDataFrame([(-1, "literal")], "id long, name string").write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("truncate", """
    SELECT 'before' AS state, count(*) AS n FROM customer UNION ALL SELECT 'after', 0""")
def truncate(t):
    path = t.scratch("truncate")
    t.customer.write.parquet(path)
    before = materialize(t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")), "count")
    m.truncate(path, t.customer.schema, t.spark)
    after = t.spark.read.parquet(path).agg(F.count("c_custkey").alias("n"))
    return before.select(F.lit("before").alias("state"), "n").unionAll(after.select(F.lit("after").alias("state"), "n"))


@query("overwrite_partitions", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT c_custkey, 'F' FROM customer""")
def overwrite_partitions(t):
    path = t.scratch("dynamic")
    files.write_partitioned(t.orders.select("o_orderkey", "o_orderstatus"), path, ["o_orderstatus"])
    new = t.customer.select(F.col("c_custkey").alias("o_orderkey"), F.lit("F").alias("o_orderstatus"))
    m.overwrite_partitions(new, path, ["o_orderstatus"])
    return t.spark.read.parquet(path)
