"""Document fingerprints: threshold-scaled sketches.

A sketch retains every shingle hash below a fixed fraction of the hash range,
so the sketch of a union is the union of sketches, and two documents can be
compared on the hashes retained however different their lengths are. Short
documents, of which a fixed fraction would be nothing, also retain their
``FLOOR`` smallest hashes; a sketch then reaches up to the largest of these,
and two sketches are compared up to the lower of their reaches, where both are
complete.

As text a sketch is its reach and its hashes, in hexadecimal digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, shingle_hashes, stored, words

WORDS = 5
#: One shingle hash in so many is retained.
SCALE = 32
FLOOR = 32
#: Bits of a hash that are kept, and the hexadecimal digits they take.
BITS = 48
DIGITS = BITS // 4
LIMIT = (1 << BITS) // SCALE
FULL = 1 << BITS


def sketch(text: bytes, n: int = WORDS) -> tuple[int, np.ndarray]:
    """Reach (all distinct hashes below it are retained) and the retained hashes, ascending."""
    hashes = np.unique(shingle_hashes(words(text), n) >> np.uint64(64 - BITS))
    if len(hashes) <= FLOOR:
        return FULL, hashes
    reach = max(LIMIT, int(hashes[FLOOR - 1]) + 1)
    return reach, hashes[: np.searchsorted(hashes, np.uint64(reach))]


def written(reach: int, hashes: np.ndarray) -> str:
    digits = hashes.astype(">u8").tobytes().hex()
    step = 16
    return f"{reach:0{DIGITS + 1}x}" + "".join(digits[i + step - DIGITS : i + step] for i in range(0, len(digits), step))


def read(fingerprint: str) -> tuple[int, np.ndarray]:
    reach = int(fingerprint[: DIGITS + 1], 16)
    rest = fingerprint[DIGITS + 1 :]
    return reach, np.array([int(rest[i : i + DIGITS], 16) for i in range(0, len(rest), DIGITS)], np.uint64)


def _common(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, int, int]:
    reach = np.uint64(min(a[0], b[0]))
    x, y = a[1][: np.searchsorted(a[1], reach)], b[1][: np.searchsorted(b[1], reach)]
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated Jaccard similarity of two documents' shingle sets; 1 for two without shingles."""
    both, x, y = _common(a, b)
    if not len(a[1]) and not len(b[1]):
        return 1.0
    return both / (x + y - both) if x + y else 0.0


def containment(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of the first document's shingles that the second holds; 1 for one without shingles."""
    both, x, _ = _common(a, b)
    if not len(a[1]):
        return 1.0
    return both / x if x else 0.0


def merged(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """Sketch of the two documents' shingles together, as far as both reach."""
    reach = min(a[0], b[0])
    hashes = np.union1d(a[1], b[1])
    return reach, hashes[: np.searchsorted(hashes, np.uint64(reach))]


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many of the start of the next."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """``docs`` plus ``fingerprint`` of ``text`` (null: empty)."""
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([written(*sketch(t, n)) for t in texts.to_pylist()], pa.string())

    return docs.withColumn("fingerprint", of(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))


RESULT = (
    "doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(doc: tuple, following: tuple, n: int) -> tuple:
    """Result row of (doc_id, text, sketch) and its successor."""
    text = edited(doc[1], following[1])
    data = text.encode("utf-8", "surrogatepass")
    own, other = doc[2], sketch(data, n)
    return (
        doc[0], len(doc[1]), hashlib.sha256(data).hexdigest(), written(*own), written(*other),
        likeness(own, other), likeness(own, following[2]),
    )


def neighbour_sketches(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """Each document's sketch against that of its edited text and of the next document, ascending ``doc_id``.

    The next of the last document is the first. Equal ids follow each other in
    order of a digest of their texts, null ids come first; each row is a
    document of its own. Null texts count as empty. Other columns are ignored;
    an empty table gives an empty result, a single document is its own next.

    Documents are range partitioned in that order, texts compressed on the way.
    A task compares neighbours as they pass and hands on its first and its last
    document; those pairs, one per task, meet in a join on the task's number.
    """
    spark = prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        return pa.array([press.compress(t) for t in texts.to_pylist()], pa.binary())

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), packed(text).alias("z"))
    rows = rows.repartitionByRange(tasks, F.asc_nulls_first("doc_id"), "tie")
    rows = rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie").select("doc_id", "z")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        press, before, key = zstandard.ZstdDecompressor(), None, None

        def batch_of(out: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
            """Result rows, then edge rows: task, whether its first document, id and text."""
            blank = (None,) * 6
            full = [(*row, None, None, None) for row in out] + [(e[2], *blank, e[0], e[1], e[3]) for e in edges]
            types = [
                key, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
                pa.int32(), pa.bool_(), pa.binary(),
            ]
            columns = list(zip(*full))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[*_NAMES, "part", "is_first", "z"]
            )

        for batch in batches:
            key, out, edges = batch.schema.field(0).type, [], []
            for doc_id, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = press.decompress(z)
                doc = doc_id, data.decode("utf-8", "replace"), sketch(data, n), z
                if before is None:
                    edges.append((part, True, doc_id, z))
                else:
                    out.append(_compared(before, doc, n))
                before = doc
            if out or edges:
                yield batch_of(out, edges)
        if before is not None:
            yield batch_of([], [(part, False, before[0], before[3])])

    shape = RESULT.format(kind=kind) + ", part int, is_first boolean, z binary"
    passed = stored(rows.mapInArrow(compare, shape), "sketches")
    inner = passed.filter("part is null").select(*_NAMES)
    # One row per task that had documents.
    edges = passed.filter("part is not null").select("doc_id", "part", "is_first", "z")
    order = Window.orderBy("part")
    parts = edges.filter("is_first").select("part")
    turns = parts.select("part", F.row_number().over(order).alias("turn"), F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("n"))
    lasts = edges.filter("not is_first").join(turns, "part").select(
        "doc_id", "z", (F.pmod(F.col("turn"), F.col("n")) + 1).alias("turn")
    )
    firsts = edges.filter("is_first").join(turns, "part").select(F.col("z").alias("z_next"), "turn")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc_id, z, z_next in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = press.decompress(z), press.decompress(z_next)
                doc = doc_id, a.decode("utf-8", "replace"), sketch(a, n)
                out.append(_compared(doc, (None, b.decode("utf-8", "replace"), sketch(b, n)), n))
            if out:
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_NAMES)

    border = lasts.join(firsts, "turn").select("doc_id", "z", "z_next").mapInArrow(settle, RESULT.format(kind=kind))
    return inner.unionByName(border)
