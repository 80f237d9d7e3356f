"""Rules, constraints, generated columns and the layers."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import quality as q

RULES = {"numbered": "order_id > 0", "in_range": "amount BETWEEN 0 AND 50", "routed": "customer_id IS NOT NULL"}


@pytest.fixture
def orders(spark):
    data = [(1, 70, 12.5), (2, None, 49.0), (None, 71, 81.0), (4, 72, None)]
    return spark.createDataFrame(data, "order_id int, customer_id int, amount double")


@pytest.mark.parametrize("action", [q.WARN, q.DROP])
def test_good_and_bad_are_the_input(orders, action):
    good, bad, counts = q.expect(orders, RULES, action)
    assert rows(good.unionAll(bad)) == rows(orders)
    assert rows(counts) == sorted([("numbered", 3, 1), ("in_range", 2, 2), ("routed", 3, 1)], key=repr)
    assert good.count() == (4 if action == q.WARN else 1)


def test_fail_names_the_rules(orders):
    with pytest.raises(q.ExpectationFailed, match="numbered"):
        q.expect(orders, RULES, q.FAIL)


def test_fail_passes_clean_rows(orders):
    good, bad, _ = q.expect(orders.filter("order_id = 1"), RULES, q.FAIL)
    assert good.count() == 1 and bad.count() == 0


def test_quarantine_is_a_partition(orders):
    valid, invalid = q.quarantine(orders, RULES)
    assert valid.count() == 1 and invalid.count() == 3
    broken = {r["order_id"]: r["_broken"] for r in invalid.collect()}
    assert broken == {2: ["routed"], None: ["numbered", "in_range"], 4: ["in_range"]}


def test_observed_counts(orders):
    watched, seen = q.observed(orders, RULES, "o1")
    watched.collect()
    assert seen.get == {"n_rows": 4, "numbered": 1, "in_range": 2, "routed": 1}


def test_check_lets_null_pass(orders):
    q.check_constraints(orders.filter("order_id = 4"), ["order_id"], {"light": "amount <= 50"})
    with pytest.raises(q.ConstraintViolation):
        q.check_constraints(orders, ["order_id"])
    with pytest.raises(q.ConstraintViolation):
        q.check_constraints(orders, checks={"light": "amount <= 50"})


def test_schema_enforcement(spark, orders):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("order_id BIGINT, amount DOUBLE, note STRING")
    got = q.enforce_schema(orders.select("order_id", "amount"), schema)
    assert got.schema == schema
    with pytest.raises(q.SchemaMismatch):
        q.enforce_schema(orders, schema)
    with pytest.raises(q.SchemaMismatch):
        q.enforce_schema(orders.select(F.col("amount").alias("order_id")), schema)


def test_generated_columns(orders):
    made = q.generated(orders, {"double_amount": "amount * 2"})
    assert made.filter("order_id = 1").first()["double_amount"] == 25.0
    with pytest.raises(q.ConstraintViolation):
        q.generated(orders.withColumn("double_amount", F.lit(1.0)), {"double_amount": "amount * 2"})


def test_surrogate_keys_have_no_gaps(spark):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 <> 0").select("id")
    ids = [r["key"] for r in q.surrogate_key(df, "key", after=50).select("key").collect()]
    assert sorted(ids) == list(range(51, 51 + 666))


def test_spike(spark):
    runs = spark.createDataFrame([(1, "a", 10), (2, "a", 15), (3, "a", 40), (1, "b", 0)], "run int, rule string, failed int")
    got = {(r["run"], r["rule"]): (r["previous"], r["spike"]) for r in q.quality_trend(runs).collect()}
    assert got == {(1, "a"): (None, False), (2, "a"): (10, False), (3, "a"): (15, True), (1, "b"): (None, False)}


def test_gate(orders):
    assert rows(q.row_count_gate(orders, 4)) == [(4, "publish")]
    assert rows(q.row_count_gate(orders, 5)) == [(4, "quarantine")]
