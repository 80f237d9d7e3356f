"""Nearest-neighbour and hybrid search over embedding columns."""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize, scratch_path
from .ordered import latest
from .sizes import measured_bytes

QUERY_BYTES = 16 * 1024 * 1024


class DimensionMismatch(ValueError):
    pass


def _checked(vector: str, dims: int) -> Column:
    """The vector as doubles; a row of another length stops the job."""
    message = F.concat(F.lit(f"expected {dims} dimensions, found "), F.size(vector).cast("string"))
    return F.when(F.size(vector) == dims, F.col(vector).cast("array<double>")).otherwise(F.raise_error(message))


def _query_shape(queries: DataFrame, vector: str) -> tuple[int, int]:
    """Number and dimensions of the query vectors."""
    row = queries.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(vector)).alias("lo"), F.max(F.size(vector)).alias("hi")).first()
    if row["lo"] != row["hi"]:
        raise DimensionMismatch(f"query vectors of {row['lo']} to {row['hi']} dimensions")
    return row["n"], row["hi"] or 0


def normalise(df: DataFrame, vector: str) -> DataFrame:
    """Unit-length vectors; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = F.transform(vector, lambda x: x.cast("double") / F.when(norm > 0, norm).otherwise(F.lit(1.0)))
    return df.withColumn(vector, unit)


class _TopK:
    """Best ``k`` candidates of each query seen by one task: smallest distance, then smallest id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.ids: list = [np.empty(0, dtype=np.int64)] * queries
        self.dist: list = [np.empty(0)] * queries

    def add(self, query: int, ids: np.ndarray, dist: np.ndarray) -> None:
        if len(dist) > self.k:
            # Everything up to the k-th distance, ties included, so ids can settle them.
            limit = np.partition(dist, self.k - 1)[self.k - 1]
            keep = dist <= limit
            ids, dist = ids[keep], dist[keep]
        ids = np.concatenate([self.ids[query], ids])
        dist = np.concatenate([self.dist[query], dist])
        order = np.lexsort((ids, dist))[: self.k]
        self.ids[query], self.dist[query] = ids[order], dist[order]

    def rows(self, query_ids: Sequence[int]) -> pd.DataFrame:
        parts = [(np.full(len(i), q, dtype=np.int64), i, d) for q, i, d in zip(query_ids, self.ids, self.dist)]
        if not parts:
            parts = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
        q, i, d = (np.concatenate(x) for x in zip(*parts))
        return pd.DataFrame({"query_id": q, "id": i, "distance": d})


def _distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    delta = vectors - query
    return np.sqrt(np.einsum("ij,ij->i", delta, delta))


_HITS = "query_id long, id long, distance double"
_HITS_ARROW = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.asarray(np.stack(column.to_numpy()), dtype=np.float64)


def _in_chunks(asked: DataFrame, key: str, row_bytes: float, limit: int, search, schema: str) -> DataFrame:
    """``search`` of every chunk of the queries; the index stays where it is and is read once per chunk.

    Chunks are cut by hash so that each takes about ``limit`` bytes in the tasks.
    The hits of all but a single chunk are stored, so that a lost executor costs
    one chunk and the plan does not grow with their number.
    """
    chunks = max(1, math.ceil(asked.count() * row_bytes / max(limit, 1)))
    if chunks == 1:
        return search(asked)
    path = scratch_path(asked.sparkSession, "hits")
    for i in range(chunks):
        part = asked.filter(F.pmod(F.xxhash64(key), F.lit(chunks)) == i)
        search(part).write.mode("append").parquet(path)
    return asked.sparkSession.read.schema(schema).parquet(path)


def _scan(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each task holds the query matrix, at most a chunk, and sends on only its best k rows per query."""
    rows = queries.orderBy("query_id").collect()
    query_ids = [r["query_id"] for r in rows]
    matrix = np.array([r["_v"] for r in rows], dtype=np.float64)
    shared = index.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = shared.value
        best = _TopK(len(ids), k)
        for batch in batches:
            if len(batch):
                block, names = _matrix(batch["_v"]), batch["id"].to_numpy()
                for n in range(len(ids)):
                    best.add(n, names, _distances(block, vectors[n]))
        yield best.rows(ids)

    return index.mapInPandas(search, _HITS)


def knn(
    index: DataFrame, queries: DataFrame, k: int, metric: str = "l2", where: str | None = None,
    key: str = "id", vector: str = "embedding", query_key: str = "query_id", columns: Sequence[str] = (),
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Exact ``k`` nearest index rows per query, ties by id, with ``rank`` and ``distance``.

    ``where`` filters the index before the search. No pair table is ever built:
    tasks keep the best k per query, and a second ranking merges those few.
    Queries are shared with every task ``query_bytes`` at a time; the index is
    never shuffled.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    if where is not None:
        index = index.filter(where)
    _, dims = _query_shape(queries, vector)
    if metric == "cosine":
        index, queries = normalise(index, vector), normalise(queries, vector)
    base = index.select(F.col(key).cast("long").alias("id"), _checked(vector, dims).alias("_v"))
    asked = queries.select(F.col(query_key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("_v"))
    hits = _in_chunks(asked, "query_id", (dims + 2) * 8, query_bytes, lambda part: _scan(base, part, k), _HITS)
    ranked = _ranked(hits, k, F.asc("distance"))
    if columns:
        extra = index.select(F.col(key).cast("long").alias("id"), *columns)
        ranked = ranked.join(extra, "id")
    return ranked


def _ranked(hits: DataFrame, k: int, first: Column) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(first, F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# --- approximate search --------------------------------------------------------


#: Vectors the cells are fitted on at most, and entries of one piece of a cell.
FIT_ROWS = 20_000
PIECE_ROWS = 50_000


@dataclass(frozen=True)
class Cells:
    """An inverted index: the centres of the cells, its rows ``cell, piece, id, _v``, and how many pieces each cell has."""

    centres: np.ndarray
    rows: DataFrame
    pieces: dict[int, int]


def _centres(sample: np.ndarray, cells: int, seed: int, turns: int = 12) -> np.ndarray:
    """Centres of k-means over a sample; a cell that runs empty starts again at the vector farthest from its centre."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(turns):
        gap = _gaps(sample, centres)
        nearest = gap.argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(centres))
        held = counts > 0
        centres = centres.copy()
        centres[held] = sums[held] / counts[held, None]
        far = np.argsort(-gap.min(axis=1))[: (~held).sum()]
        centres[np.flatnonzero(~held)[: len(far)]] = sample[far]
    return centres


def _gaps(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, up to rounding."""
    return (vectors**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * vectors @ centres.T


def _placed(rows: DataFrame, centres: np.ndarray, most: int, stretch: float | None) -> DataFrame:
    """Rows ``id, _v`` once per cell: the ``most`` nearest ones, or of these only those within ``stretch`` of the nearest."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType([T.StructField("cell", T.IntegerType()), *rows.schema.fields])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            gap = np.sqrt(np.maximum(_gaps(_matrix(batch["_v"]), shared.value), 0))
            near = np.argsort(gap, axis=1, kind="stable")[:, :most]
            kept = np.ones(near.shape, bool)
            if stretch is not None:
                own = np.take_along_axis(gap, near, axis=1)
                kept = own <= own[:, :1] * stretch
            row, place = np.nonzero(kept)
            out = batch.iloc[row].reset_index(drop=True)
            out.insert(0, "cell", near[row, place].astype(np.int32))
            yield out

    return rows.mapInPandas(place, schema)


def build_cells(
    index: DataFrame, key: str = "id", vector: str = "embedding", cells: int | None = None, copies: int = 4, stretch: float = 1.25,
    seed: int = 3,
) -> Cells:
    """Divide the index into k-means cells and store it by cell.

    A vector near a border lies in up to ``copies`` cells: those whose centres
    are at most ``stretch`` times as far as the nearest one. The centres are
    fitted on the ``FIT_ROWS`` rows of smallest hash; every row is placed. There
    are ``sqrt(rows)`` cells by default, at least 16. Large cells are cut into
    pieces, so that none is a single task.
    """
    base = index.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("_v"))
    rows = base.count()
    if not rows:
        raise ValueError("an index without rows has no cells")
    sample = base.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).collect()
    vectors = np.array([r["_v"] for r in sample], dtype=np.float64)
    cells = cells or max(16, math.isqrt(rows))
    centres = _centres(vectors, min(cells, len(vectors)), seed)
    placed = materialize(_placed(base, centres, copies, stretch), "cells")
    sizes = placed.groupBy("cell").count().collect()  # one row per cell
    pieces = {r["cell"]: math.ceil(r["count"] / PIECE_ROWS) for r in sizes}
    number = F.pmod(F.xxhash64("id"), _pieces_of(pieces)).cast("int")
    laid = placed.withColumn("piece", number).repartition("cell", "piece").sortWithinPartitions("cell", "piece")
    return Cells(centres, materialize(laid, "cells-laid"), pieces)


def _pieces_of(pieces: dict[int, int]) -> Column:
    """Pieces of the cell of a row: only cells of several pieces are listed."""
    listed = [x for c, n in sorted(pieces.items()) if n > 1 for x in (F.lit(c), F.lit(n))]
    return F.coalesce(F.create_map(*listed)[F.col("cell")], F.lit(1)) if listed else F.lit(1)


def search_cells(
    held: Cells, queries: DataFrame, k: int, probes: int | None = None, vector: str = "embedding", query_key: str = "query_id",
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Nearest rows among the ``probes`` nearest cells of each query, a quarter of the cells by default.

    Distances are exact; only rows in cells that were not probed can be missed.
    Queries go to the cells they probe, ``chunk_rows`` of them at a time, and
    every piece returns at most k rows per query.
    """
    probes = probes or max(1, len(held.centres) // 4)
    asked = queries.select(F.col(query_key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("_v"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        best = _TopK(b.num_rows, k)
        if a.num_rows and b.num_rows:
            block, vectors = _table_matrix(a), _table_matrix(b)
            names = a.column("id").to_numpy()
            gap = _gaps(vectors, block)
            some = min(k + 8, a.num_rows)
            for n in range(b.num_rows):
                # Rounding moves close distances: all within its reach of the k-th are measured again.
                limit = np.partition(gap[n], some - 1)[some - 1]
                near = np.flatnonzero(gap[n] <= limit + 1e-9 * (1 + abs(limit) + (vectors[n] ** 2).sum()))
                best.add(n, names[near], _distances(block[near], vectors[n]))
        return pa.Table.from_pandas(best.rows(b.column("id").to_pylist()), schema=_HITS_ARROW, preserve_index=False)

    def search(part: DataFrame) -> DataFrame:
        wanted = _placed(part, held.centres, probes, None)
        wanted = wanted.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces_of(held.pieces) - 1)))
        return held.rows.groupBy("cell", "piece").cogroup(wanted.groupBy("cell", "piece")).applyInArrow(meet, _HITS)

    hits = _in_chunks(asked, "id", 1, chunk_rows, search, _HITS)
    once = hits.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))  # copies of a border vector
    return _ranked(once, k, F.asc("distance"))


def _table_matrix(table: pa.Table) -> np.ndarray:
    column = table.column("_v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def knn_ann(
    index: DataFrame, queries: DataFrame, k: int, key: str = "id", vector: str = "embedding", query_key: str = "query_id",
    cells: int | None = None, probes: int | None = None, copies: int = 4, stretch: float = 1.25,
) -> DataFrame:
    """Approximate neighbours of every query, from cells built for this search."""
    held = build_cells(index, key, vector, cells, copies, stretch)
    return search_cells(held, queries, k, probes, vector, query_key)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact neighbours the approximate search found."""
    found = exact.join(approximate.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left")
    return found.agg(F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found")).withColumn(
        "recall", F.col("found") / F.col("wanted")
    )


# --- keyword and hybrid search ---------------------------------------------------


# A word is a run of these letters and digits in the lower-cased text.
_NOT_WORD = "[^a-z0-9]+"


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), _NOT_WORD), "")


@dataclass(frozen=True)
class Postings:
    """Words of documents by block, ``n`` documents of ``mean`` words.

    A row is a block of documents that lay together: their ids and lengths, the
    block's words, and for each word, from its place in ``starts`` on, the
    documents (as places in ``ids``) that hold it, with their counts.
    """

    rows: DataFrame
    n: int
    mean: float

    def frequencies(self) -> DataFrame:
        """Documents that hold a word."""
        ends = F.concat(F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))), F.array(F.size("docs")))
        held = self.rows.select(F.explode(F.arrays_zip("words", F.zip_with(ends, "starts", lambda a, b: a - b).alias("df"))).alias("w"))
        return held.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.df").alias("df"))


#: Documents of a block, and words at which it is closed earlier.
BLOCK_DOCS = 4096
BLOCK_WORDS = 1 << 20
_BLOCK = "ids array<long>, sizes array<long>, words array<string>, starts array<int>, docs array<int>, tf array<int>"
_BLOCK_ARROW = pa.schema([
    ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("words", pa.list_(pa.string())),
    ("starts", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())),
])


def _block(ids: pa.Array, texts: pa.Array, asked: pa.Array | None) -> pa.RecordBatch:
    """One block of lower-cased texts; only the asked words are listed, all are counted for the lengths."""
    lists = pc.split_pattern_regex(texts, _NOT_WORD)
    pieces = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    real = pc.greater(pc.binary_length(pieces), 0)
    doc, pieces = doc[real.to_numpy(zero_copy_only=False)], pieces.filter(real)
    sizes = np.bincount(doc, minlength=len(texts))
    if asked is None:
        coded = pieces.dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        names = asked
        codes = pc.fill_null(pc.index_in(pieces, value_set=asked), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        doc, codes = doc[codes >= 0], codes[codes >= 0]
    pairs, tf = np.unique(codes * len(texts) + doc, return_counts=True)
    found, starts = np.unique(pairs // len(texts), return_index=True)
    parts = [
        ids, pa.array(sizes, pa.int64()), names.take(pa.array(found)), pa.array(starts.astype(np.int32)),
        pa.array((pairs % len(texts)).astype(np.int32)), pa.array(tf.astype(np.int32)),
    ]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), p) for p in parts]
    return pa.RecordBatch.from_arrays(lists, schema=_BLOCK_ARROW)


def build_postings(
    documents: DataFrame, key: str = "id", text: str = "text", block_docs: int = BLOCK_DOCS, words: DataFrame | None = None
) -> Postings:
    """Read the texts once and store which words they hold, block by block; nothing is shuffled.

    A block takes at most ``block_docs`` documents of one task and ends earlier
    where they are long. ``words`` (a column ``word``) limits the postings to
    those words, as long as they are few enough for every task.
    """
    docs = documents.select(F.col(key).cast("long").alias("id"), F.coalesce(F.lower(text), F.lit("")).alias("_t"))
    shared = None
    if words is not None:
        words = words.select("word").distinct()
        if measured_bytes(words) <= QUERY_BYTES:
            shared = docs.sparkSession.sparkContext.broadcast([r["word"] for r in words.collect()])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if shared is None else pa.array(shared.value, pa.string())
        held, docs, size = [], 0, 0
        for batch in batches:
            bytes_ = pc.binary_length(batch.column("_t")).to_numpy(zero_copy_only=False)
            start = 0
            for at in range(batch.num_rows):
                docs, size = docs + 1, size + int(bytes_[at])
                if docs >= block_docs or size >= 8 * BLOCK_WORDS:
                    held.append(batch.slice(start, at + 1 - start))
                    yield _joined(held, asked)
                    held, docs, size, start = [], 0, 0, at + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield _joined(held, asked)

    rows = materialize(docs.mapInArrow(blocks, _BLOCK), "postings")
    length = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)
    total = rows.agg(F.sum(F.size("ids")).alias("n"), F.sum(length).alias("words")).first()
    n = total["n"] or 0
    return Postings(rows, n, (total["words"] or 0) / max(n, 1) or 1.0)


def _joined(parts: list[pa.RecordBatch], asked: pa.Array | None) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    return _block(table.column("id").combine_chunks(), table.column("_t").combine_chunks(), asked)


class _BlockScorer:
    """BM25 of one chunk of queries against blocks; a block is scored only for the queries it can matter to."""

    def __init__(self, queries: Sequence[np.ndarray], vocabulary: pa.Array, idf: np.ndarray, k: int, k1: float, b: float, mean: float):
        """``queries`` hold places in the vocabulary."""
        self.vocabulary, self.idf, self.k1, self.b, self.mean = vocabulary, idf, k1, b, mean
        asking = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
        words = np.concatenate([*queries, np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(words, kind="stable")
        self.asking = asking[order]
        self.counts = np.bincount(words, minlength=len(idf))
        self.first = np.cumsum(self.counts) - self.counts
        self.best = _TopK(len(queries), k)
        self.met = self.scored = 0

    def _pairs(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The queries that ask for each word, flat, and the place of the word each belongs to."""
        n = self.counts[word]
        at = np.repeat(self.first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.asking[at], np.repeat(np.arange(len(word)), n)

    def add(self, block: dict[str, pa.Array]) -> None:
        number = pc.fill_null(pc.index_in(block["words"], value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(number >= 0)
        if not len(known):
            return
        ids, sizes, starts, docs, tf = (
            block[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "sizes", "starts", "docs", "tf")
        )
        weight = tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * sizes[docs] / self.mean))
        highest = np.maximum.reduceat(weight, starts)[known]
        ends = np.append(starts[1:], len(docs))[known]
        starts, word = starts[known], number[known].astype(np.int64)
        query, place = self._pairs(word)
        bound = np.bincount(query, weights=self.idf[word[place]] * highest[place], minlength=len(self.best.ids))
        # Bounds and scores are sums in different orders.
        least = np.array([-d[-1] if len(d) >= self.best.k else -np.inf for d in self.best.dist])
        needed = (bound > 0) & (bound >= least - 1e-6)
        self.met += int((bound > 0).sum())
        self.scored += int(needed.sum())
        keep = needed[query]
        query, place = query[keep], place[keep]
        n = ends[place] - starts[place]
        post = np.repeat(starts[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        value = np.repeat(self.idf[word[place]], n) * weight[post]
        hits, inverse = np.unique(np.repeat(query, n) * len(ids) + docs[post], return_inverse=True)
        score = np.round(np.bincount(inverse, weights=value, minlength=len(hits)), 9)
        names, parts = _runs(hits // len(ids))
        for q, part in zip(names.tolist(), parts):
            self.best.add(q, ids[hits[part] % len(ids)], -score[part])


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    names, starts = np.unique(ordered, return_index=True)
    ends = np.append(starts[1:], len(ordered))
    return names, [slice(a, b) for a, b in zip(starts, ends)]


def _scorer(asked: DataFrame, held: Postings, k: int, k1: float, b: float) -> tuple[list[int], _BlockScorer]:
    """Query ids and a scorer for one chunk of queries."""
    pairs = asked.join(held.frequencies(), "word").collect()  # a chunk, cut by size
    df = {r["word"]: r["df"] for r in pairs}
    words = sorted(df)
    number = {w: i for i, w in enumerate(words)}
    per_query: dict[int, list[int]] = {}
    for r in pairs:
        per_query.setdefault(r["query_id"], []).append(number[r["word"]])
    names = sorted(per_query)
    often = np.array([df[w] for w in words], float)
    idf = np.log(1 + (held.n - often + 0.5) / (often + 0.5))
    queries = [np.array(per_query[q], np.int64) for q in names]
    return names, _BlockScorer(queries, pa.array(words, pa.string()), idf, k, k1, b, held.mean)


def search_postings(held: Postings, asked: DataFrame, k: int, query_bytes: int = QUERY_BYTES, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Best ``k`` documents for queries ``query_id, word``, ties by id.

    Queries go ``query_bytes`` at a time to where the blocks lie. The highest
    weight of each word of a block bounds what its documents can score; a block
    that cannot reach the k-th score a task has found is passed over.
    """

    def search(part: DataFrame) -> DataFrame:
        shared = part.sparkSession.sparkContext.broadcast(_scorer(part, held, k, k1, b))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, scorer = shared.value
            scorer = copy.deepcopy(scorer)
            for batch in batches:
                for row in range(batch.num_rows):
                    scorer.add({c: batch.column(c)[row].values for c in batch.schema.names})
            yield pa.RecordBatch.from_pandas(scorer.best.rows(names), schema=_HITS_ARROW, preserve_index=False)

        return held.rows.mapInArrow(score, _HITS)

    each = measured_bytes(asked) / max(asked.count(), 1)
    hits = _in_chunks(asked, "query_id", each, query_bytes, search, _HITS)
    return _ranked(hits.select("query_id", "id", (-F.col("distance")).alias("score")), k, F.desc("score"))


def keyword_search(
    documents: DataFrame, queries: DataFrame, k: int, key: str = "id", text: str = "text", query_key: str = "query_id",
    query_text: str = "text", k1: float = 1.2, b: float = 0.75, query_bytes: int = QUERY_BYTES, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Best ``k`` documents per query by BM25, ties by id, with ``rank`` and ``score``.

    Texts are read once, into postings of the words the queries ask for; these
    are what every chunk of queries meets. A NULL text counts as empty.
    """
    asked = queries.select(
        F.col(query_key).cast("long").alias("query_id"), F.explode(F.array_distinct(tokens(query_text))).alias("word")
    )
    held = build_postings(documents, key, text, block_docs, asked)
    return search_postings(held, asked, k, query_bytes, k1, b)


def fuse(rankings: Sequence[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of rankings with ``(query_id, id, rank)``."""
    parts = None
    for r in rankings:
        part = r.select("query_id", "id", (F.lit(1.0) / (F.col("rank") + constant)).alias("part"))
        parts = part if parts is None else parts.unionAll(part)
    fused = parts.groupBy("query_id", "id").agg(F.round(F.sum("part"), 9).alias("score"))
    return _ranked(fused, k, F.desc("score"))


def hybrid_search(
    index: DataFrame, queries: DataFrame, k: int, depth: int = 50, key: str = "id", text: str = "text",
    vector: str = "embedding", query_key: str = "query_id",
) -> DataFrame:
    """Keyword and vector rankings, each ``depth`` deep, fused by rank.

    Rows and queries may lack the text or the vector; they take part in the other ranking.
    """
    by_word = keyword_search(index.filter(F.col(text).isNotNull()), queries, depth, key, text, query_key)
    with_vector = F.col(vector).isNotNull()
    by_vector = knn(index.filter(with_vector), queries.filter(with_vector), depth, key=key, vector=vector, query_key=query_key)
    return fuse([by_word, by_vector], k)


# --- index upkeep and scoring ----------------------------------------------------


def index_sync(index: DataFrame, feed: DataFrame, key: str, sequence: str = "_commit_version") -> DataFrame:
    """Index after a change feed: newest image per key is upserted, deletes leave."""
    from .merge import Delete, Insert, Update, merge

    last = latest(feed.filter("_change_type <> 'update_preimage'"), [key], [F.desc(sequence)])
    values = {c: f"s.`{c}`" for c in index.columns}
    return merge(
        index, last, [key],
        matched=[Delete("s._change_type = 'delete'"), Update(values)],
        not_matched=[Insert(values, "s._change_type <> 'delete'")],
    )


def batch_score(df: DataFrame, model, columns: Sequence[str], out: str, kind: T.DataType | str = "double") -> DataFrame:
    """Add ``model(pandas frame of columns) -> values`` as a column, one Arrow batch at a time."""
    kind = kind.simpleString() if isinstance(kind, T.DataType) else kind
    schema = T.StructType([*df.schema.fields]).add(out, kind)

    def run(batches):
        for batch in batches:
            yield batch.assign(**{out: model(batch[list(columns)])})

    return df.mapInPandas(run, schema)
