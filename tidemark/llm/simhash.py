"""SimHash near-duplicates found with vantage-point trees.

Each text gets a 64-bit fingerprint. Cut into ``k // 2 + 1`` runs of bits, two
fingerprints that differ in at most ``k`` bits differ in at most one bit in one
of the runs, so there is one vantage-point tree per run, searched with radius
one. The upper levels of a tree deal the distinct fingerprints out to shards: each has one home shard and visits every later shard that the triangle bound
does not rule out. Within a shard a task grows the tree further, prunes
by the same bound and compares what is left on all 64 bits. A task returns a
spanning forest of its links, never the pairs, and the forests are joined by
distributed star contraction.

Whatever sample shapes the trees, the bounds hold for every fingerprint: the
sample decides how even the shards are, not what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_folder, settings
from ..sources.swap import remove
from .common import fresh, hash_share, prepare, shingle_hashes, stored, text_bytes, with_row_id, words

WORDS = 3
DISTANCE = 3
#: Fingerprints a shard should be home to.
SHARD_ROWS = 50_000
#: Sampled fingerprints per shard, from which vantage points and radii are taken; shards are at most MAX_SHARDS.
SAMPLE_PER_SHARD = 48
MAX_SHARDS = 65_536
#: Cells compared in one step within a shard.
CELLS = 1 << 21
#: Bands of MinHash values that bring texts together by their shingle sets, and values per band: two sets of Jaccard
#: similarity s share a band with probability 1 - (1 - s ** BAND_ROWS) ** BANDS, at 0.8 all but 5 in 100,000 pairs.
BANDS, BAND_ROWS = 25, 5
#: Rounds in which one text of each fingerprint and band meets the others, and the step between classes of set sizes.
HEAD_ROUNDS = 2
SIZE_STEP = 1.02
#: Longs of the map of a set's hashes that goes along where shingles meet.
MARK_LONGS = 8
#: The near-copy joins meet in shuffles, small ones too: the driver would collect and hold the hash table of every broadcast.
SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, n: int = WORDS) -> int:
    """Majority of the bits of all shingle hashes (repeats count); 0 without words."""
    hashes = shingle_hashes(words(text), n)
    if not len(hashes):
        return 0
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 1500:
        counts = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, columns: list[str], n: int, name: str) -> DataFrame:
    """``columns`` of ``docs`` plus the fingerprint of ``text`` as a signed long named ``name``."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t, n) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return docs.select(*columns, of(text_bytes()).alias(name))


class Tree:
    """The upper levels of a vantage-point tree over runs of bits, as a complete binary tree of ``depth`` levels."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.vantage = np.zeros((1 << depth) - 1, np.uint64)
        self.radius = np.zeros((1 << depth) - 1, np.int64)
        self._grow(sample, 0)

    def _grow(self, sample: np.ndarray, node: int) -> None:
        if node >= len(self.vantage):
            return
        self.vantage[node], self.radius[node], inner = split(sample)
        self._grow(sample[inner], 2 * node + 1)
        self._grow(sample[~inner], 2 * node + 2)

    def shards(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, shards and whether the shard is the row's home; foreign shards only after the home shard."""
        rows, nodes = np.arange(len(points)), np.zeros(len(points), np.int64)
        home = np.ones(len(points), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(points[rows] ^ self.vantage[nodes]).astype(np.int64)
            mu = self.radius[nodes]
            inner, outer = d <= mu, d > mu
            see_in, see_out = d - reach <= mu, d + reach > mu
            rows, nodes, home = (
                np.concatenate([rows[see_in], rows[see_out]]),
                np.concatenate([2 * nodes[see_in] + 1, 2 * nodes[see_out] + 2]),
                np.concatenate([(home & inner)[see_in], (home & outer)[see_out]]),
            )
        leaf = nodes - len(self.vantage)
        own = np.empty(len(points), np.int64)
        own[rows[home]] = leaf[home]
        wanted = leaf >= own[rows]
        return rows[wanted], leaf[wanted], home[wanted]


def split(points: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Vantage point, radius and who lies inside: of a few candidates the one whose distances spread most."""
    if not len(points):
        return 0, 0, np.empty(0, bool)
    best = None
    for at in np.linspace(0, len(points) - 1, min(5, len(points))).astype(int):
        d = np.bitwise_count(points ^ points[at]).astype(np.int64)
        mu = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
        inner = d <= mu
        score = abs(2 * int(inner.sum()) - len(d)) - d.std()
        if best is None or score < best[0]:
            best = score, int(points[at]), mu, inner
    return best[1:]


def _run(values: np.ndarray, tree: int, runs: int) -> np.ndarray:
    """The bits of run ``tree`` out of ``runs``."""
    low, high = 64 * tree // runs, 64 * (tree + 1) // runs
    return (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


class _Forest:
    """Union-find over positions, merged by whole arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            differ = a != b
            a, b = a[differ], b[differ]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(self.parent, high, low)
            a, b = low, high


class _Nearest:
    """The nearest other fingerprint of each position, as far as seen."""

    def __init__(self, n: int):
        self.distance = np.full(n, 255, np.uint8)
        self.at = np.arange(n)

    def see(self, queries: np.ndarray, members: np.ndarray, distances: np.ndarray) -> None:
        distances = np.where(queries[:, None] == members[None, :], np.uint8(255), distances)
        best = distances.argmin(axis=1)
        d = distances[np.arange(len(queries)), best]
        closer = d < self.distance[queries]
        self.distance[queries[closer]] = d[closer]
        self.at[queries[closer]] = members[best[closer]]


def _search(values, runs, members, queries, reach, distance, forest, nearest) -> None:
    """Link every query to the members within ``distance``, by a vantage-point tree over ``members``."""
    todo = [(members, queries)]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        if len(m) > 64 and len(m) * len(q) > 4096:
            vantage, mu, inner = split(runs[m])
            if inner.any() and not inner.all():
                d = np.bitwise_count(runs[q] ^ np.uint64(vantage)).astype(np.int64)
                todo.append((m[inner], q[d - reach <= mu]))
                todo.append((m[~inner], q[d + reach > mu]))
                continue
        step = max(1, CELLS // len(m))
        for at in range(0, len(q), step):
            part = q[at : at + step]
            apart = np.bitwise_count(values[part][:, None] ^ values[m][None, :])
            i, j = np.nonzero(apart <= distance)
            forest.link(part[i], m[j])
            if nearest is not None:
                nearest.see(part, m, apart)


def shard_links(
    values: np.ndarray, home: np.ndarray, tree: int, distance: int, nearest: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Links of one shard: a spanning forest and, if asked for, each fingerprint's nearest one."""
    runs, everyone = distance // 2 + 1, np.arange(len(values))
    forest, closest = _Forest(len(values)), _Nearest(len(values)) if nearest else None
    _search(values, _run(values, tree, runs), np.flatnonzero(home), everyone, distance // runs, distance, forest, closest)
    root = forest.find(everyone)
    tied = root != everyone
    a, b = everyone[tied], root[tied]
    if nearest:
        near = closest.distance <= distance
        a, b = np.concatenate([a, everyone[near]]), np.concatenate([b, closest.at[near]])
    return values[a], values[b]


def near_links(
    prints: DataFrame, distance: int = DISTANCE, shard_rows: int = SHARD_ROWS, nearest: bool = False
) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly the distinct fingerprints ``fp`` within ``distance`` bits of each other.

    With ``nearest`` each shard adds the nearest fingerprint of every one it has seen.
    """
    spark = prints.sparkSession
    n = prints.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(n / shard_rows, min(tasks, n / 2000), 1)
    depth = int(np.ceil(np.log2(min(wanted, MAX_SHARDS))))
    share = min(1.0, SAMPLE_PER_SHARD * (1 << depth) / max(n, 1))
    sample = prints.filter(hash_share(share, "fp")).orderBy(F.xxhash64("fp")).limit(2 * SAMPLE_PER_SHARD << depth).toPandas()
    sample = sample["fp"].to_numpy(np.int64).view(np.uint64)
    runs = distance // 2 + 1
    shared = spark.sparkContext.broadcast([Tree(_run(sample, t, runs), depth) for t in range(runs)])
    reach = distance // runs

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            values = signed.view(np.uint64)
            for number, tree in enumerate(shared.value):
                rows, leaf, home = tree.shards(_run(values, number, runs), reach)
                shard = (leaf * runs + number).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(signed[rows]), pa.array(home)], names=["shard", "fp", "home"]
                )

    def link(key: tuple, part: pa.Table) -> pa.Table:
        values = part.column("fp").to_numpy().view(np.uint64)
        a, b = shard_links(values, part.column("home").to_numpy(), key[0].as_py() % runs, distance, nearest)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = prints.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(link, "a long, b long")


def star_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node of each connected component, for all nodes of ``edges`` (``a``, ``b``).

    Alternates the large-star and small-star contractions; each step is a
    minimum per node and a join, so no neighbourhood is collected, and each
    result is stored so that lost executors cost one step.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "m")
        small = small.select(F.explode(F.array("x", "y")).alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_groups(docs: DataFrame, n: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that links reach, its own
    included. A null text counts as empty; texts without words share
    fingerprint zero and are linked like any other. Null ids are never the
    smallest unless a component has no other (then it is null); repeated rows
    stay repeated. Other columns of ``docs`` are ignored; an empty table gives
    an empty result.
    """
    prepare(docs.sparkSession)
    prints = stored(fingerprints(docs, ["doc_id"], n, "fp"), "prints")
    grouped = component_ids(prints, distance)
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def component_ids(prints: DataFrame, distance: int) -> DataFrame:
    """``prints`` (``doc_id``, ``fp``, more) plus ``component_id``."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = stored(star_components(near_links(distinct, distance)), "roots")
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "component_id"), "fp")


def set_fingerprint(tokens: list[bytes], seed: int) -> int:
    """Majority of the bits of the hashes of the distinct words; 0 without words."""
    distinct = set(tokens)
    if not distinct:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))
    counts = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _drop_prints(seeds: tuple[int, ...]):
    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            tokens = words(text)
            values = np.array([set_fingerprint(tokens, s) for s in seeds], np.uint64)
            rows.append(values.view(np.int64).tolist())
        return pa.array(rows, pa.list_(pa.int64()))

    return of


_draw = np.random.default_rng(64)
_MIX = _draw.integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64)
_ODD = _draw.integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band of the MinHash values of a set of hashes; equal keys in a band mean equal values."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        least = np.minimum(least, ((part[:, None] ^ _MIX[None, :]) * _ODD[None, :]).min(axis=0))
    return [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, BAND_ROWS))]


def _band_prints(n: int):
    """Number of distinct shingles and the keys of the bands."""

    @F.arrow_udf("struct<m:long,keys:array<long>>")
    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            hashes = np.unique(shingle_hashes(words(text), n))
            rows.append({"m": len(hashes), "keys": np.array(band_keys(hashes), np.uint64).view(np.int64).tolist()})
        return pa.array(rows, pa.struct([("m", pa.int64()), ("keys", pa.list_(pa.int64()))]))

    return of


def _set_hashes(n: int):
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingle_hashes(words(t), n)).tobytes() for t in texts.to_pylist()], pa.binary())

    return of


def bit_map(hashes: np.ndarray) -> bytes:
    """Which leading bits the hashes of a set have, in 8 to 16 bits per hash."""
    power = 3 + max(len(hashes) - 1, 0).bit_length()
    held = np.zeros(1 << power, bool)
    held[hashes >> np.uint64(64 - power)] = True
    return np.packbits(held).tobytes()


def most_alike(m: int, a: bytes, k: int, b: bytes) -> float:
    """A bound that the Jaccard similarity of sets of ``m`` and ``k`` hashes cannot exceed, from their bit maps.

    Each bit that only one of the maps has stands for a hash that only its set has.
    """
    x, y = np.unpackbits(np.frombuffer(a, np.uint8)), np.unpackbits(np.frombuffer(b, np.uint8))
    size = min(len(x), len(y))
    x, y = x.reshape(size, -1).any(axis=1), y.reshape(size, -1).any(axis=1)
    both = min(m - int((x & ~y).sum()), k - int((y & ~x).sum()))
    return both / (m + k - both) if m + k else 1.0


def _bit_maps():
    @F.arrow_udf("binary")
    def of(sets: pa.Array) -> pa.Array:
        return pa.array([bit_map(np.frombuffer(s, np.uint64)) for s in sets.to_pylist()], pa.binary())

    return of


def _marks():
    """Which leading bits the hashes of a set have, in ``MARK_LONGS`` longs."""

    @F.arrow_udf("array<long>")
    def of(sets: pa.Array) -> pa.Array:
        shift = np.uint64(64 - (64 * MARK_LONGS - 1).bit_length())
        rows = []
        for s in sets.to_pylist():
            held = np.zeros(64 * MARK_LONGS, bool)
            held[np.frombuffer(s, np.uint64) >> shift] = True
            rows.append(np.packbits(held).view(np.int64))
        return pa.array(rows, pa.list_(pa.int64()))

    return of


def _most_alike():
    @F.arrow_udf("double")
    def of(m: pa.Array, a: pa.Array, k: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([most_alike(*x) for x in zip(*(c.to_pylist() for c in (m, a, k, b)))], pa.float64())

    return of


def _jaccard():
    @F.arrow_udf("double")
    def of(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0)
        return pa.array(out, pa.float64())

    return of


def _occurrences(sets: DataFrame) -> DataFrame:
    """``node``, ``m``, ``s``: a row for every shingle of every set, with the size of its set."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(s, np.int64) for s in batch.column("s").to_pylist()]
            sizes = np.array([len(h) for h in held], np.int64)
            nodes = np.repeat(np.asarray(batch.column("node")), sizes)
            hashes = np.concatenate([*held, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.repeat(sizes, sizes)), pa.array(hashes)], names=["node", "m", "s"]
            )

    return sets.select("node", "s").mapInArrow(spread, "node long, m long, s long")


def prefix_pairs(sets: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a > b`` of sets (``node``, ``s``) of different groups, among them all whose Jaccard similarity reaches ``similarity``.

    In any one order of all shingles, two similar sets of m and k share one of
    the first ``m - o + 1`` and ``k - o + 1``, where ``o`` is the overlap their
    sizes ask for. Rare shingles come first, so sets that differ in shingles of
    their own do not meet, though they share all others. Sizes go by classes of
    2 %, each pair of classes with prefixes of its own length; shingles of a
    single set are counted for their places, but make no rows. Under a shingle
    the sets of its largest group only meet those of others, and two sets are a
    pair only if maps of their hashes leave room for the overlap.
    """
    t = similarity / (1 + similarity)
    occurrences = _occurrences(sets)
    often = occurrences.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    mine = Window.partitionBy("node")
    place = F.col("m") - F.count(F.lit(1)).over(mine) + F.row_number().over(mine.orderBy("c", "s"))
    placed = occurrences.join(often, "s").withColumn("place", place)
    placed = placed.filter(F.col("place") <= F.col("m") - F.ceil(similarity * F.col("m") - 1e-6) + 1)

    def size_class(m: Column) -> Column:
        return F.floor(F.log(m.cast("double")) / math.log(SIZE_STEP)).cast("int")

    placed = placed.withColumn("own", size_class(F.col("m")))
    lowest, highest = size_class(F.ceil(similarity * F.col("m") - 1e-6)), size_class(F.floor(F.col("m") / similarity + 1e-6))
    aimed = placed.withColumn("other", F.explode(F.sequence(lowest, highest)))
    least = F.greatest(F.pow(F.lit(SIZE_STEP), F.col("other")) * (1 - 1e-9), similarity * F.col("m"))
    aimed = aimed.filter(F.col("place") <= F.col("m") - F.ceil(t * (F.col("m") + least) - 1e-6) + 1)
    key = ["low", "high", "s"]
    rows = aimed.select(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "s", "node", "m", "own")
    rows = stored(rows.join(groups, "node"), "prefixes")
    counted = rows.groupBy(*key, "group").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy(*key).agg(F.max(F.struct("n", "group")).alias("g"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    largest = largest.select(*key, F.col("g.group").alias("largest"))
    # Only rows of shingles that several groups have take their set's marks along.
    rows = stored(rows.join(largest, key).join(sets.select("node", _marks()("s").alias("marks")), "node"), "meeting")
    fewer = rows.filter("group <> largest").select(*key, *(F.col(c).alias(f"x_{c}") for c in ("node", "m", "own", "group", "marks")))
    fewer = fewer.withColumnsRenamed({"x_node": "x", "x_m": "xm", "x_own": "xo", "x_group": "xg"})
    # Marks that only one of the sets has stand for shingles that the other lacks, which bounds what they share.
    lacks = [
        sum((F.bit_count(F.col(a)[i].bitwiseAND(F.bitwise_not(F.col(b)[i]))) for i in range(MARK_LONGS)), F.lit(0))
        for a, b in (("marks", "x_marks"), ("x_marks", "marks"))
    ]
    close = F.least("m", "xm") + 1e-9 >= similarity * F.greatest("m", "xm")
    room = F.least(F.col("m") - lacks[0], F.col("xm") - lacks[1]) + 1e-6 >= t * (F.col("m") + F.col("xm"))
    apart = (F.col("group") != F.col("xg")) & ((F.col("low") == F.col("high")) | (F.col("own") != F.col("xo")))
    pairs = fewer.join(rows, key).filter(apart & close & room)
    return pairs.select(F.greatest("node", "x").alias("a"), F.least("node", "x").alias("b")).distinct()


def drop_near_copies(
    docs: DataFrame, n: int = 5, similarity: float = 0.8, distance: int = 5, seeds: tuple[int, ...] = (42, 43)
) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns kept.

    Two texts are near copies if the sets of their ``n``-word shingles have a
    Jaccard similarity of ``similarity`` or more. Candidates come from
    fingerprints over distinct words, one per seed, linked at ``distance`` bits,
    and from bands of MinHash values of the shingle sets, which meet with a
    probability that depends on the similarity alone and not on where a text
    was edited. The links of the fingerprints are compared first, then ``HEAD_ROUNDS``
    times one text of each fingerprint and band with all others of it that are
    not in its group yet. What still shares one across groups goes through an
    exact join on rare shingles, which finds every similar pair among these
    texts without comparing all that share a band. Comparisons are exact and
    only similar pairs join groups. Equal texts form one class beforehand. The row of the smallest id stays, null ids last, then the first
    stored row. Null texts count as empty; texts without words are near copies
    of each other. Repeated rows leave one row; an empty table stays empty.
    """
    spark = prepare(docs.sparkSession)
    rid = fresh(docs.columns)
    whole = with_row_id(docs, "docs", rid)
    first = F.struct(F.col("id").isNull(), "id", "rid")
    with settings(spark, SHUFFLED):
        with scratch_folder(spark, "near-copies") as own:
            slim, classes, roots = _near_copies(whole, rid, first, n, similarity, distance, seeds)
        members = slim.join(classes.select("k1", "k2", "node"), ["k1", "k2"]).join(roots, "node", "left")
        kept = members.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min_by("rid", first).alias(rid)).select(rid)
        kept = stored(kept, "kept")
    remove(spark, own)
    return whole.join(kept, rid, "left_semi").drop(rid)


def _near_copies(
    whole: DataFrame, rid: str, first: Column, n: int, similarity: float, distance: int, seeds: tuple[int, ...]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their text's hashes, the classes of equal texts, and the group of each class that is in one."""
    text = text_bytes()
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
    slim = whole.select(F.col(rid).alias("rid"), F.col("doc_id").alias("id"), *keys, _drop_prints(seeds)(text).alias("fps"), _band_prints(n)(text).alias("bands"))
    slim = stored(slim, "prints")
    classes = slim.groupBy("k1", "k2").agg(*(F.min_by(c, first).alias(x) for c, x in (("rid", "node"), ("fps", "fps"), ("bands", "bands"))))
    classes = stored(classes, "classes")
    parts = []
    for at in range(len(seeds)):
        heads = classes.groupBy(F.element_at("fps", at + 1).alias("fp")).agg(F.min("node").alias("head"))
        heads = stored(heads, "heads")
        links = near_links(heads, distance, nearest=True)
        parts.append(
            links.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a")
            .join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        )
    tried = stored(reduce(DataFrame.unionByName, parts).filter("a <> b").distinct(), "candidates")
    same = [F.xxhash64(F.lit(at), F.element_at("fps", at + 1)) for at in range(len(seeds))]
    met = classes.select("node", F.col("bands.m").alias("m"), F.explode(F.concat(F.array(*same), "bands.keys")).alias("key"))
    met = stored(met.join(met.groupBy("key").count().filter("count > 1").select("key"), "key", "left_semi"), "met")
    ends = met.select("node").unionByName(tried.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    sets = whole.select(F.col(rid).alias("node"), text.alias("t")).join(ends, "node", "left_semi")
    sets = stored(sets.select("node", _set_hashes(n)(F.col("t")).alias("s")), "sets")
    maps = stored(sets.select("node", (F.octet_length("s") / 8).cast("long").alias("m"), _bit_maps()(F.col("s")).alias("bits")), "maps")

    def alike(pairs: DataFrame) -> DataFrame:
        # Maps are an eighth to a quarter of the sets; only pairs they do not rule out carry whole sets.
        likely = pairs.join(maps.select(F.col("node").alias("a"), F.col("m").alias("ma"), F.col("bits").alias("xa")), "a").join(
            maps.select(F.col("node").alias("b"), F.col("m").alias("mb"), F.col("bits").alias("xb")), "b"
        )
        pairs = stored(likely.filter(_most_alike()("ma", "xa", "mb", "xb") + 1e-9 >= similarity).select("a", "b"), "likely")
        compared = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b"
        )
        return stored(compared.filter(_jaccard()("sa", "sb") >= similarity).select("a", "b"), "alike")

    # Texts of one set of shingles, and all without shingles, hang on their first.
    twins = sets.withColumn("h", F.xxhash64("s")).withColumn("head", F.min("node").over(Window.partitionBy("h")))
    twins = twins.filter("head < node").select(F.col("node").alias("a"), F.col("head").alias("b"))
    tried = stored(tried.unionByName(twins).distinct(), "candidates")
    similar = alike(tried)
    for turn in range(HEAD_ROUNDS + 1):
        roots = stored(star_components(similar), "roots")
        met = met.join(roots, "node", "left").select("key", "node", "m", F.coalesce("root", "node").alias("group"))
        split_keys = met.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
        met = stored(met.join(split_keys, "key", "left_semi"), "met")
        if turn == HEAD_ROUNDS or met.isEmpty():
            break
        place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("node"), "node"))
        heads = stored(met.withColumn("place", place).filter("place = 1").drop("place"), "heads")
        other = heads.select("key", F.col("node").alias("head"), F.col("m").alias("hm"), F.col("group").alias("hg"))
        # A set is at most as similar to another as the smaller is large.
        close = F.least("m", "hm") + 1e-9 >= similarity * F.greatest("m", "hm")
        pairs = met.join(other, "key").filter(close & (F.col("group") != F.col("hg")))
        pairs = pairs.select(F.greatest("node", "head").alias("a"), F.least("node", "head").alias("b")).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "candidates")
        similar, tried = similar.unionByName(alike(pairs)), tried.unionByName(pairs)
        # Heads have met everyone of their keys.
        met = met.join(heads.select("key", "node"), ["key", "node"], "left_anti").select("key", "node", "m")
    open_ = met.select("node", "group").distinct()
    if not open_.isEmpty():
        pairs = prefix_pairs(sets.join(open_, "node", "left_semi"), open_, similarity)
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "candidates")
        roots = stored(star_components(similar.unionByName(alike(pairs))), "roots")
    return slim, classes, roots
