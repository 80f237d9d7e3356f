"""Queries over audit, network, usage and maintenance records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .relational import any_ilike, join_range, within_last


def failure_bursts(
    events: DataFrame, user: str, at: str, source: str, failed: str, as_of: str, minutes: int = 15, at_least: int = 5
) -> DataFrame:
    """Users with many failures in the last minutes: count, last attempt and sources.

    Sources are made distinct before they are listed, so one busy source costs
    one entry.
    """
    recent = within_last(events, at, as_of, minutes=minutes).filter(F.expr(failed))
    per_source = recent.groupBy(user, source).agg(F.count(F.lit(1)).alias("_n"), F.max(at).alias("_last"))
    per_user = per_source.groupBy(user).agg(
        F.sum("_n").alias("failures"), F.max("_last").alias("last_attempt"),
        F.array_sort(F.collect_list(F.col(source).cast("string"))).alias("sources"),
    )
    return per_user.filter(F.col("failures") >= at_least)


def sensitive_access(events: DataFrame, at: str, as_of: str, days: int, actions: Sequence[str], key: str, wanted, columns: Sequence[str]) -> DataFrame:
    """Who touched a given object lately, newest first; the object is a map entry of the request."""
    recent = within_last(events, at, as_of, days=days)
    hits = recent.filter(F.col("action_name").isin(*actions) & (F.col("request_params")[key] == wanted))
    return hits.select(*columns).orderBy(F.desc(at), *[c for c in columns if c != at])


def change_audit(events: DataFrame, at: str, as_of: str, days: int, actions: Sequence[str] = (), patterns: Sequence[str] = ()) -> DataFrame:
    """Records of listed actions or matching name patterns, newest first."""
    picked = F.lit(False)
    if actions:
        picked = picked | F.col("action_name").isin(*actions)
    if patterns:
        picked = picked | any_ilike("action_name", patterns)
    return within_last(events, at, as_of, days=days).filter(picked)


def denied(events: DataFrame, at: str, status: str, tie: str, n: int = 100, floor: int = 400) -> DataFrame:
    return events.filter(F.col(status) >= floor).orderBy(F.desc(at), F.desc(tie)).limit(n)


def network_denials(events: DataFrame) -> DataFrame:
    """Flat view of denied connections kept in nested records."""
    return events.filter(F.col("decision") == "DENY").select(
        "event_time", F.col("source.user").alias("source_user"), F.col("source.address").alias("source_address"),
        F.col("destination.name").alias("destination"), F.col("rule.id").alias("rule_id"),
    )


def usage_by_day(usage: DataFrame, day: str, sku: str, quantity: str, as_of: str, days: int = 30) -> DataFrame:
    recent = within_last(usage, day, as_of, days=days)
    return recent.groupBy(day, sku).agg(F.round(F.sum(quantity), 2).alias("units"))


def usage_cost(usage: DataFrame, prices: DataFrame, day: str, sku: str, at: str, quantity: str, open_until: str) -> DataFrame:
    """Quantity and cost per day and SKU at the price in force when the usage ended.

    Usage is summed per SKU and instant before it meets the prices, so a hot
    SKU reaches the join as one row per instant.
    """
    summed = usage.groupBy(day, sku, at).agg(F.sum(quantity).alias("_q"))
    priced = join_range(summed, prices, [sku], at, "price_start", "price_end", "month", open_until)
    return priced.groupBy(day, sku).agg(
        F.round(F.sum("_q"), 2).alias("qty"), F.round(F.sum(F.col("_q") * F.col("unit_price")), 4).alias("cost")
    )


def upstream(lineage: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """Direct sources of a table or of one of its columns."""
    rows = lineage.filter(F.col("target_table") == table)
    if column is not None:
        rows = rows.filter(F.col("target_column") == column)
    return rows.select("source_table", "source_column", "target_table", "target_column").distinct()


def maintenance_history(operations: DataFrame, at: str, as_of: str, days: int = 7) -> DataFrame:
    recent = within_last(operations, at, as_of, days=days)
    return recent.groupBy("operation_type", "operation_status").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("usage"), 4).alias("usage"), F.max(at).alias("last_run")
    )
