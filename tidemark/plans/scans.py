"""Scans, generators, message records and table writes."""

from pyspark.sql import functions as F

from ..sources import files, generate, messages
from .registry import query


@query("gen_range", """
    WITH n AS (SELECT unnest(range((SELECT count(*) FROM orders))) AS id)
    SELECT id, CAST(id % 10 AS INT) AS country_code, CAST(id % 8 AS INT) AS quarter FROM n""")
def gen_range(t):
    return generate.gen_range(t.spark, t.orders.count(), {"country_code": 10, "quarter": 8}, ["amount"]).drop("amount")


@query("gen_skewed", """
    SELECT CASE WHEN o_orderkey % 10 < 7 THEN 0 ELSE o_orderkey % 50 + 1 END AS key,
           count(*) AS n_rows, round(sum(o_totalprice), 2) AS amount
    FROM orders GROUP BY 1""")
def gen_skewed(t):
    fact = t.orders.withColumn("key", generate.skewed_key_modulo("o_orderkey", 7, 50))
    return fact.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("amount")
    )


@query("inline_rows", """
    SELECT c_mktsegment, v.label, count(*) AS n
    FROM customer LEFT JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm'), ('HOUSEHOLD', 'h')) AS v(seg, label)
      ON c_mktsegment = v.seg GROUP BY ALL""")
def inline_rows(t):
    rows = [("BUILDING", "b"), ("MACHINERY", "m"), ("HOUSEHOLD", "h")]
    names = generate.inline_rows(t.spark, rows, "seg string, label string")
    joined = t.customer.join(F.broadcast(names), F.col("c_mktsegment") == F.col("seg"), "left")
    return joined.groupBy("c_mktsegment", "label").agg(F.count(F.lit(1)).alias("n"))


@query("scan_parquet", """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45""")
def scan_parquet(t):
    return (
        files.scan_parquet(t.spark, t.path("lineitem"), merge_schema=True)
        .filter("l_quantity > 45")
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query("scan_json", """
    SELECT c_custkey, c_name, c_acctbal FROM customer""")
def scan_json(t):
    path = t.scratch("json")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.json(path)
    return files.scan_json(t.spark, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")


@query("scan_json_inferred", """
    SELECT count(*) AS n, round(sum(c_acctbal), 2) AS total, max(c_custkey) AS top_key FROM customer""")
def scan_json_inferred(t):
    path = t.scratch("json")
    t.customer.select("c_custkey", "c_acctbal").write.json(path)
    return files.scan_json(t.spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.max("c_custkey").alias("top_key")
    )


@query("scan_csv", """
    SELECT p_partkey, p_name, p_size, p_retailprice FROM part""")
def scan_csv(t):
    path = t.scratch("csv")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", "true").csv(path)
    return files.scan_csv(t.spark, path, "p_partkey BIGINT, p_name STRING, p_size INT, p_retailprice DOUBLE")


@query("file_metadata_cols", """
    SELECT 'orders.parquet' AS file, count(*) AS n, true AS loaded FROM orders""")
def file_metadata_cols(t):
    df = files.with_file_metadata(t.orders.select("o_orderkey", "_metadata"))
    name = F.regexp_extract("_source_file", r"(orders\.parquet)", 1)
    return df.groupBy(name.alias("file")).agg(
        F.count(F.lit(1)).alias("n"), (F.min("_load_time") <= F.current_timestamp()).alias("loaded")
    )


def _records(t):
    body = F.to_json(F.struct("user_id", F.col("event_type").alias("event"), "value"))
    return t.events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


@query("kafka_decode", """
    SELECT user_id, event_type AS event, value, 'events' AS topic, CAST(event_id % 4 AS INT) AS "partition",
           event_id AS "offset", ts AS "timestamp" FROM events""")
def kafka_decode(t):
    return messages.decode(_records(t), "user_id INT, event STRING, value DOUBLE")


@query("kafka_encode", """
    SELECT CAST(user_id AS VARCHAR) AS key,
           '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""")
def kafka_encode(t):
    return messages.encode(t.events, "user_id", ["event_id", "user_id", "event_type"])


@query("write_modes", """
    SELECT 'append' AS mode, 2 * count(*) AS n FROM customer
    UNION ALL SELECT 'overwrite', count(*) FROM customer""")
def write_modes(t):
    path = t.scratch("append")
    files.write_table(t.customer, path)
    files.write_table(t.customer, path, mode="append")
    once = t.scratch("overwrite")
    files.write_table(t.supplier, once)
    files.write_table(t.customer, once, mode="overwrite")
    read = t.spark.read.parquet
    return (
        read(path).select(F.lit("append").alias("mode")).unionAll(read(once).select(F.lit("overwrite").alias("mode")))
    ).groupBy("mode").agg(F.count(F.lit(1)).alias("n"))


@query("write_partitioned", """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1""")
def write_partitioned(t):
    path = t.scratch("by-month")
    files.write_partitioned(t.orders, path, {"month": F.date_format("o_orderdate", "yyyy-MM")})
    back = t.spark.read.option("partitionColumnTypeInference.enabled", "false").parquet(path)
    return back.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("list_partitions", """
    SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS "partition", true AS has_files FROM orders""")
def list_partitions(t):
    path = t.scratch("by-status")
    files.write_partitioned(t.orders, path, ["o_orderstatus"])
    found = files.list_partitions(t.spark, path)
    return found.select("partition", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query("write_bucketed", """
    SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1""")
def write_bucketed(t):
    path = t.scratch("bucketed")
    table = "tm_" + path.rsplit("-", 1)[1]
    files.write_bucketed(t.orders, table, path, 8, ["o_custkey"])
    return t.spark.table(table).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("write_capped", """
    SELECT count(*) AS n, true AS capped FROM orders""")
def write_capped(t):
    path = t.scratch("capped")
    files.write_table(t.orders, path, max_records_per_file=5000)
    per_file = t.spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(F.sum("rows").alias("n"), (F.max("rows") <= 5000).alias("capped"))


@query("ctas", """
    SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS avg_price FROM orders GROUP BY 1""")
def ctas(t):
    made = t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("avg_price")
    )
    return files.create_table_as(made, t.scratch("ctas"))


@query("replace_table", """
    SELECT c_custkey, upper(c_name) AS c_name FROM customer""")
def replace_table(t):
    path = t.scratch("replace")
    files.create_table_as(t.customer, path)
    # The new rows come out of the old table.
    old = t.spark.read.parquet(path)
    return files.create_table_as(old.select("c_custkey", F.upper("c_name").alias("c_name")), path, replace=True)


@query("create_like", """
    SELECT column_name AS name, 0 AS n
    FROM (DESCRIBE orders) GROUP BY 1""")
def create_like(t):
    made = files.create_like(t.orders, t.scratch("like"))
    counts = made.agg(*[F.count(c).alias(c) for c in made.columns])
    return counts.unpivot([], made.columns, "name", "n")
