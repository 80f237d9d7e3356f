"""Read-only scans of external database tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Numeric column and range by which a database read is divided among tasks."""

    column: str
    lower: int
    upper: int
    parts: int


def scan_options(url: str, table: str, driver: str | None = None, split: Split | None = None) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "fetchsize": "10000",
    }
    if driver:
        options["driver"] = driver
    if split:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return options


def federated_scan(spark: SparkSession, url: str, table: str, driver: str | None = None, split: Split | None = None) -> DataFrame:
    """External table as a DataFrame; filters and aggregates on it are pushed to the database."""
    return spark.read.format("jdbc").options(**scan_options(url, table, driver, split)).load()
