"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import Tables

MODULES = (
    "scans", "projections", "joins", "aggregates", "scalars", "distribution", "streams", "loading",
    "mutations", "history", "changes", "checks", "policies", "audits", "files", "search",
)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, root: str) -> DataFrame:
        return self.build(Tables(spark, root))


_queries: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated builder under ``name``."""

    def register(build):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = Query(name, build, sql)
        return build

    return register


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
    return dict(_queries)
