"""Tables kept up batch by batch in key buckets: a batch reads and writes only the buckets of its keys.

Below the root, ``v=<batch>/<table>/__bucket=<n>`` holds the rows of one bucket as
the batch left them. A map file per batch says which version of each bucket
counts; it is written under another name first, so a batch is there as a whole or
not at all. Batches come in the order of their numbers, each perhaps more than
once: one whose number is not above the newest map has been applied already and
is skipped, and what a failed attempt wrote is overwritten by the next. Buckets
that neither of the last two maps names are deleted, so a reader of the last but
one version is not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources import swap

#: Bucket of rows that belong to no key.
SHARED = -1


class KeyedState:
    """State tables below ``root``, split by the hash of ``keys`` into ``buckets``; the number must not change later."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _maps(self) -> list[str]:
        return sorted(n for n in swap.children(self.spark, f"{self.root}/_maps") if n.endswith(".json"))

    def newest(self) -> dict:
        """Number of the last batch, the version of every bucket of every table, and the tables' schemas."""
        maps = self._maps()
        if not maps:
            return {"batch": -1, "versions": {}, "schemas": {}}
        return json.loads(swap.read_text(self.spark, f"{self.root}/_maps/{maps[-1]}"))

    def _place(self, table: str, bucket: str, version: int) -> str:
        return f"{self.root}/v={version}/{table}/__bucket={bucket}"

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of a table, or of some of its buckets; None before its first batch."""
        now = self.newest()
        if table not in now["schemas"]:
            return None
        schema = T.StructType.fromJson(json.loads(now["schemas"][table]))
        held = now["versions"].get(table, {})
        chosen = held if buckets is None else {b: held[b] for b in map(str, buckets) if b in held}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._place(table, b, v) for b, v in chosen.items()])

    def apply(
        self,
        rows: DataFrame,
        batch: int,
        change: Callable[[Mapping[str, DataFrame | None], DataFrame], Mapping[str, DataFrame]],
        tables: Sequence[str],
        shared: Column | None = None,
    ) -> dict:
        """Replace the buckets that ``rows`` touch by what ``change`` makes of them.

        ``change`` gets the touched buckets of every table and the rows, and gives
        the new tables. Rows for which ``shared`` holds belong to no key; their
        bucket is read with every batch. Returns what was read and written.
        """
        before = self.newest()
        if batch <= before["batch"]:
            return {"batch": batch, "skipped": True, "read": 0, "written": 0}
        number = self.bucket() if shared is None else F.when(shared, SHARED).otherwise(self.bucket())
        rows = rows.persist()
        try:
            # At most as many numbers as there are buckets.
            touched = {r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect()}
            if not touched:
                return {"batch": batch, "skipped": True, "read": 0, "written": 0}
            chosen = sorted(touched if shared is None else touched | {SHARED})
            versions = {t: dict(before["versions"].get(t, {})) for t in tables}
            read = sum(str(b) in versions[t] for t in tables for b in chosen)
            after = change({t: self.read(t, chosen) for t in tables}, rows)
            schemas, written = dict(before["schemas"]), 0
            for table in tables:
                place = f"{self.root}/v={batch}/{table}"
                df = after[table]
                schemas[table] = df.schema.json()
                laid = df.withColumn("__bucket", number).hint("rebalance", "__bucket")
                laid.write.mode("overwrite").partitionBy("__bucket").parquet(place)
                for b in chosen:
                    versions[table].pop(str(b), None)
                for name in swap.children(self.spark, place):
                    if name.startswith("__bucket="):
                        versions[table][name.removeprefix("__bucket=")] = batch
                        written += 1
        finally:
            rows.unpersist()
        self._commit({"batch": batch, "versions": versions, "schemas": schemas})
        return {"batch": batch, "skipped": False, "read": read, "written": written}

    def _commit(self, state: dict) -> None:
        old = [json.loads(swap.read_text(self.spark, f"{self.root}/_maps/{n}")) for n in self._maps()]
        swap.write_whole(self.spark, f"{self.root}/_maps/{state['batch']:020d}.json", json.dumps(state))
        kept = [state, *old[-1:]]
        live = {(t, b, v) for m in kept for t, held in m["versions"].items() for b, v in held.items()}
        for gone in old[:-1]:
            for t, held in gone["versions"].items():
                for b, v in held.items():
                    if (t, b, v) not in live:
                        swap.remove(self.spark, self._place(t, b, v))
            swap.remove(self.spark, f"{self.root}/_maps/{gone['batch']:020d}.json")
