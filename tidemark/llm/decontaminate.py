"""Benchmark decontamination: short test items found inside long documents.

There are no partitions by size: each item has a signature of its own length,
which stands in for them and is exact. An item of m distinct shingles is stood
for by its k smallest shingle hashes, its MinHash signature, with
``k = m - ceil(t * m) + 1``: a document that holds at least a share t of the m shingles lacks fewer than k of them, so it holds at
least one hash of the signature, however long it is. Documents probe their
shingle hashes against the signatures; what meets is verified by the exact
share of the item's shingles.

Items are the query set. They are taken in blocks whose signatures fit a
bounded broadcast, each block against all documents.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, prepare, shingle_hashes, stored, text_bytes, with_row_id, words

WORDS = 5
CONTAINED = 0.8
#: Bytes of item texts whose shingles are broadcast at a time.
BLOCK_BYTES = 8 << 20
#: Bits, as a power of two, of the table that rules most document shingles out.
SIEVE = 22


class Items:
    """Shingles and signatures of one block of items, by shingle length."""

    def __init__(self, texts: list[tuple[int, bytes]], n: int, share: float):
        self.shingles: list[np.ndarray] = []
        self.ids: list[int] = []
        self.needed: list[int] = []
        signatures: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item, text in texts:
            tokens = words(text)
            if not tokens:
                continue
            length = min(n, len(tokens))
            hashes = np.unique(shingle_hashes(tokens, length))
            needed = math.ceil(share * len(hashes) - 1e-9)
            number = len(self.ids)
            self.ids.append(item)
            self.shingles.append(hashes)
            self.needed.append(needed)
            for h in hashes[: len(hashes) - needed + 1].tolist():
                signatures[length][h].append(number)
        self.probes = {}
        for length, table in signatures.items():
            keys = np.array(sorted(table), np.uint64)
            sieve = np.zeros(1 << SIEVE, bool)
            sieve[keys >> np.uint64(64 - SIEVE)] = True
            self.probes[length] = keys, [table[k] for k in keys.tolist()], sieve

    def find(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """Items held by a text: place of the item, shingles shared, shingles of the item."""
        tokens = words(text)
        for length, (keys, owners, sieve) in self.probes.items():
            if len(tokens) < length:
                continue
            hashes = shingle_hashes(tokens, length)
            likely = hashes[sieve[hashes >> np.uint64(64 - SIEVE)]]
            at = np.searchsorted(keys, likely)
            at[at == len(keys)] = 0
            met = {number for i in np.unique(at[keys[at] == likely]).tolist() for number in owners[i]}
            if not met:
                continue
            own = np.unique(hashes)
            for number in sorted(met):
                shared = int(np.isin(self.shingles[number], own, assume_unique=True).sum())
                if shared >= self.needed[number]:
                    yield number, shared, len(self.shingles[number])


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of at most ``BLOCK_BYTES`` of text (or one item), in the order of their numbers."""
    sized = benchmark.select("item_id", text_bytes().alias("t")).filter(F.octet_length("t") > 0).distinct()
    block, size = [], 0
    for row in sized.orderBy("item_id", "t").toLocalIterator():
        text = bytes(row["t"])
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def contained_items(
    docs: DataFrame, benchmark: DataFrame, n: int = WORDS, share: float = CONTAINED, key: str = "doc_id"
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``share`` of the distinct ``n``-word shingles.

    Columns: the ``key`` of the document, ``item_id``, ``n_shared``,
    ``n_shingles``, ``containment``. Items of fewer than ``n`` words are one
    shingle of all their words; items and documents without words match
    nothing, null texts count as empty. Repeated document rows each give their
    pairs; equal items count once. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, item_id long, n_shared long, n_shingles long, containment double"
    found = []
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Items(block, n, share))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items, rows = shared.value, []
                for place, text in enumerate(batch.column(1).to_pylist()):
                    rows.extend((place, *hit) for hit in items.find(text))
                keys = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array([items.ids[r[1]] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[2] / r[3] for r in rows], pa.float64()),
                    ],
                    names=[key, "item_id", "n_shared", "n_shingles", "containment"],
                )

        found.append(docs.select(key, text_bytes().alias("_text")).mapInArrow(probe, schema))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, share: float = CONTAINED) -> DataFrame:
    """``docs`` without the rows that hold an item of ``benchmark``, columns unchanged."""
    prepare(docs.sparkSession)
    rid = fresh(docs.columns)
    whole = with_row_id(docs, "docs", rid)
    hit = stored(contained_items(whole, benchmark, n, share, rid).select(rid).distinct(), "contaminated")
    return whole.join(hit, rid, "left_anti").drop(rid)
