"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale: a count c
has level ``1 + floor(log2(c))``. The filter holds an n-gram once for each level
up to its own, so a level is read back by probing one level after another until
a probe fails. A false positive needs all probes of a level to hit by chance,
and each further level as many again, so errors are small and rare.

The model is a pair model over all words, interpolated with single words::

    P(w | v) = (q(v, w) + (C(v) - S(v)) * P(w)) / C(v),  C(v) = max(c(v), S(v)) + T(v)
    P(w)     = (q(w) + 1/2) / (Q + (V + 1) / 2)

with q the middle of a level, c(v) the count of v, S, T sum and number of the
kept pairs that begin with v, and Q, V sum and number of all words. Pairs of
any two words count, if seen ``LEAST_PAIRS`` times; what the kept pairs leave
of v goes to single words. All sums run over quantised values, so probabilities
add up to one but for false positives.

Everything the corpus gives is counted over all training rows. What is sent to
the workers is bounded: the filters of words and of pairs have at most
``MAX_BITS`` and ``PAIR_BITS`` bits, and exact counts and sums go out for
``HEAD`` words. Up to there the filters grow with the number of n-grams. What
does not go out is looked up exactly: pairs whose levels have no room in the
filter, pairs that begin with a word beyond the ``HEAD`` and the sums of such
words are kept in a table, and a document's n-grams that may be in it leave as
(row, key) and meet them in a join.

The base score needs the exact count of every word. Counts of the vocabulary go
to the workers; rarer words leave a document as (row, word, times) and meet
their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .common import fold, prepare, stored, text_bytes, words

#: The end of a text; holds white space, so it is no word.
END = b"\n"
#: Words whose exact counts and sums of pairs go to the workers.
HEAD = 1 << 17
PROBES = 2
BITS_PER_ENTRY = 8
#: Bits of the filter of words, and at most of the filter of pairs.
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
PAIR_BITS = 1 << 28
#: Pairs seen less often are left out; a pair seen once says little.
LEAST_PAIRS = 2
LEAST_LEVEL = LEAST_PAIRS.bit_length()
TRAIN_FOLD, FOLDS = 1, 5
#: Segments of the filter, each put together by one task.
SEGMENTS = 64

#: A number whose xxhash64 is 1.
HASHED_1 = -7682426122119481604
#: Set in the numbers of words beyond the head.
BEYOND = np.uint64(1 << 63)
#: Pairs gathered in a task before they are summed and sent, and pairs that one group gets at most.
HELD_PAIRS, GROUP_PAIRS = 400_000, 1_000_000
#: Bytes of text that a task cuts into words at a time, if texts are not longer.
HELD_BYTES = 1 << 19
#: Entries of the filter that a task turns into bits at a time.
HELD_ENTRIES = 1 << 16

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def level(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def middle(levels: np.ndarray) -> np.ndarray:
    """The value a level stands for: the middle of its counts, 0 for level 0."""
    return np.where(levels > 0, 0.75 * 2.0**levels, 0.0) - np.where(levels == 1, 0.5, 0.0)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLY
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashed(keys: np.ndarray, at: int) -> np.ndarray:
    """Hash of each n-gram at a level."""
    return _spread(keys + np.uint64(at * 0xD1342543DE82EF95 % (1 << 64)))


def places(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Bit that a probe looks at for each hash."""
    if probe:
        h = h + np.uint64(probe) * (_spread(h ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1))
    return h & np.uint64(bits - 1)


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 1)


def word_keys(column: str):
    """``word_key`` of a column. Spark's ``xxhash64`` takes the hash of one column as the seed of the next; that of ``HASHED_1`` is 1."""
    return F.xxhash64(F.lit(HASHED_1), column)


def runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Where runs of texts begin and end that hold ``HELD_BYTES`` or one text more, so that long texts are not all in words at once."""
    begin = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= HELD_BYTES or i == len(texts):
            yield begin, i
            begin, size = i, 0


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of pairs of words, from the numbers of the words."""
    return _spread(_spread(first + np.uint64(0xC2B2AE3D27D4EB4F)) + second)


def alike(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together, and where each key begins in it."""
    order = np.argsort(keys)
    keys = keys[order]
    return order, np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))


class LogFilter:
    """Quantised counts of n-grams behind one bit array."""

    def __init__(self, data: np.ndarray, bits: int):
        self.data, self.bits = data, bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probed upwards until a probe fails."""
        found = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        at = 1
        while len(alive):
            h = hashed(keys[alive], at)
            for probe in range(PROBES):
                row = places(h, probe, self.bits)
                hit = (self.data[row >> np.uint64(3)] >> (row & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                alive, h = alive[hit], h[hit]
            found[alive] = at
            at += 1
        return found


class Lexicon:
    """What the workers know of single words: the filter of all, and exact counts of the most frequent."""

    def __init__(self, filter_: LogFilter, head: dict[bytes, int]):
        self.filter, self.head = filter_, head

    def read(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the texts, where each text begins, and each token's place in the head (or -1), number and level.

        The number of a word of the head is its place, that of any other its hash with the highest bit set.
        """
        if not hasattr(self, "keys"):
            # The last place stands for a word beyond the head.
            self.keys = np.fromiter(map(word_key, [*self.head, b""]), np.uint64, len(self.head) + 1)
            self.levels = self.filter.levels(self.keys)
        get = self.head.get
        tokens: list[bytes] = []
        starts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            starts[i] = len(tokens)
            tokens += words(text)
            tokens.append(END)
        ids = np.fromiter(map(get, tokens, repeat(-1)), np.int64, len(tokens))
        numbers, levels = ids.astype(np.uint64), self.levels[ids]
        rare = np.flatnonzero(ids < 0)
        keys = np.fromiter((word_key(tokens[k]) for k in rare.tolist()), np.uint64, len(rare))
        numbers[rare] = keys | BEYOND
        levels[rare] = self.filter.levels(keys)
        return tokens, starts, ids, numbers, levels


class Model:
    """What the workers get for scores: counts and sums of the head, and the filter of pairs."""

    def __init__(self, pairs: LogFilter, counts: np.ndarray, totals: tuple, sums: np.ndarray, kinds: np.ndarray, lowest: int, whole: bool):
        self.pairs, self.counts, self.sums, self.lowest, self.whole = pairs, counts, sums, lowest, whole
        self.n, self.v, self.q = totals
        self.all = np.maximum(counts, sums) + kinds
        self.base = np.log10((counts + 0.5) / (self.n + 0.5 * (self.v + 1)))

    def score_batch(self, lexicon: Lexicon, texts: list[bytes]) -> Iterator[tuple]:
        """Per text: tokens, known vocabulary tokens, base score of these, score, its other words with their numbers, and
        the keys to look up, each with 1 / P(w) for a pair and 0 for the word a pair begins with.
        """
        tokens, starts, ids, numbers, levels = lexicon.read(texts)
        rare = np.flatnonzero(ids < 0)
        p = (middle(levels) + 0.5) / (self.q + 0.5 * (self.v + 1))
        # Words seen less often than any kept pair are in none.
        often = levels >= LEAST_LEVEL
        follows = np.ones(len(ids), bool)
        follows[starts] = False
        later = np.flatnonzero(follows)
        later = later[often[later - 1]]
        v = ids[later - 1]
        inside = v >= 0
        ratio = 1.0 / p
        s, c = self.sums[v[inside]], self.all[v[inside]]
        paired = np.flatnonzero(often[later])
        asked = pair_keys(numbers[later - 1][paired], numbers[later][paired])
        found = np.zeros(len(later), np.int64)
        found[paired] = self.pairs.levels(asked)
        found[found < self.lowest] = 0  # the filter has no pair of so low a level
        at = later[inside]
        seen = s > 0
        p[at[seen]] = ((middle(found[inside]) + (c - s) * p[at])[seen]) / c[seen]
        # To be looked up: what the filter may not hold, and all pairs that begin with a word beyond the head.
        outside = ~inside[paired]
        open_ = np.where(outside, (found[paired] > 0) | (not self.whole), (found[paired] == 0) & (not self.whole))
        where = np.concatenate([later[paired][open_], later[~inside]])
        sought = np.concatenate([asked[open_], numbers[later[~inside] - 1]])
        weight = np.concatenate([ratio[later[paired][open_]], np.zeros(int((~inside).sum()))])
        order = np.argsort(where, kind="stable")
        where, sought, weight = where[order], sought[order], weight[order]
        logs = np.log10(np.minimum(p, 1.0))
        base = np.where(ids >= 0, self.base[np.maximum(ids, 0)], 0.0) if len(self.base) else np.zeros(len(ids))
        bounds = np.append(starts, len(tokens))
        cuts = [x.tolist() for x in (bounds, np.searchsorted(rare, bounds), np.searchsorted(where, bounds))]
        for a, b, i, j, k, m in zip(*(x[at:][: len(texts)] for x in cuts for at in (0, 1))):
            others = Counter(tokens[x] for x in rare[i:j].tolist())
            yield b - a, b - a - (j - i), float(base[a:b].sum()), float(logs[a:b].sum()), others, sought[k:m], weight[k:m]


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``c`` over ``t``, the end of each text counted as a word; summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[bytes] = Counter()

        def hand_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(tally), pa.binary()), pa.array(list(tally.values()), pa.int64())], names=["word", "c"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tally.update(words(text))
                tally[END] += 1
                if len(tally) > 200_000:
                    yield hand_on()
                    tally.clear()
        if tally:
            yield hand_on()

    return texts.select("t").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte: the highest bytes of all, and so on down, as the zeros of small ones compress well that way."""
    return x.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(">u8").reshape(-1).astype(np.uint64)


def pair_counts(texts: DataFrame, lexicon: Broadcast, n: int) -> DataFrame:
    """``key``, ``first`` (number of the first word), ``c`` of all pairs of words seen ``LEAST_PAIRS`` times in ``n`` tokens.

    Pairs of any words count, summed in each task before the shuffle. A pair
    with a word that the filter knows to be too rare for that does not leave
    its task. Pairs travel in blocks, one for each range of keys; the number of
    ranges follows ``n``, so that no group gets more than ``GROUP_PAIRS`` on average.
    """
    width = -(-(1 << 64) // max(1, -(-n // GROUP_PAIRS)))
    bounds = np.array(range(width, 1 << 64, width), np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def hand_on() -> pa.RecordBatch:
            first, second = (np.concatenate(x) for x in zip(*held))
            key = pair_keys(first, second)
            order, at = alike(key)
            c = np.diff(np.append(at, len(key))).astype(np.uint64)
            at = order[at]
            first, second, key = first[at], second[at], key[at]
            cuts = [0, *np.searchsorted(key, bounds).tolist(), len(key)]
            ranges = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            columns = [pa.array([i for i, _, _ in ranges], pa.int32())]
            columns += [pa.array([_planes(x[a:b]) for _, a, b in ranges], pa.binary()) for x in (first, second, c)]
            return pa.RecordBatch.from_arrays(columns, names=["part", "a", "b", "n"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in runs(texts):
                _, starts, _, numbers, levels = lexicon.value.read(texts[begin:end])
                often = levels >= LEAST_LEVEL
                both = often[:-1] & often[1:]
                both[starts[1:] - 1] = False
                at = np.flatnonzero(both)
                held.append((numbers[at], numbers[at + 1]))
                size += len(at)
                if size > HELD_PAIRS:
                    yield hand_on()
                    held, size = [], 0
        if size:
            yield hand_on()

    def add(part: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[_from_planes(x) for x in row] for block in blocks for row in zip(*(block.column(c).to_pylist() for c in ("a", "b", "n")))]
        first, second, c = (np.concatenate(x) for x in zip(*held))
        key = pair_keys(first, second)
        del held, second
        order, at = alike(key)
        c = np.add.reduceat(c[order], at).astype(np.int64)
        kept = c >= LEAST_PAIRS
        at = order[at[kept]]
        columns = [pa.array(key[at].view(np.int64)), pa.array(first[at].view(np.int64)), pa.array(c[kept])]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "first", "c"])

    blocks = texts.select("t").mapInArrow(count, "part int, a binary, b binary, n binary")
    return blocks.groupBy("part").applyInArrow(add, "key long, first long, c long")


def _level(column: str):
    """Level of a count of at least 1: its number of binary digits."""
    return F.length(F.bin(F.col(column)))


def _middle(column: str):
    lv = _level(column)
    return F.when(lv == 1, F.lit(1.0)).otherwise(0.75 * F.pow(F.lit(2.0), lv))


def build_filter(entries: DataFrame, n_entries: int, most: int | None = None) -> LogFilter:
    """Filter of ``entries`` (``key``, ``level``, each standing for all levels up to it).

    Tasks turn entries into bits by segment, a segment is put together by one
    task from bit arrays of a fixed size, and the driver gets ``SEGMENTS``
    arrays of at most ``most / SEGMENTS`` bits (``MAX_BITS`` without ``most``).
    """
    bits = 1 << max(int(math.log2(MIN_BITS)), min(int(math.log2(most or MAX_BITS)), math.ceil(math.log2(max(n_entries * BITS_PER_ENTRY, 1)))))
    piece = bits // SEGMENTS // 8

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.zeros(bits // 8, np.uint8)
        held, size = [], 0

        def put():
            keys, levels = (np.concatenate(x) for x in zip(*held))
            for at in range(1, int(levels.max(initial=0)) + 1):
                h = hashed(keys[levels >= at], at)
                for row in (places(h, probe, bits) for probe in range(PROBES)):
                    np.bitwise_or.at(data, row >> np.uint64(3), np.uint8(1) << (row & np.uint64(7)).astype(np.uint8))

        for batch in batches:
            held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.int64)))
            size += len(batch)
            if size > HELD_ENTRIES:
                put()
                held, size = [], 0
        if size:
            put()
        for s in range(SEGMENTS):
            part = data[s * piece : (s + 1) * piece]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["s", "b"])

    def join(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.zeros(piece, np.uint8)
        for batch in parts:
            for b in batch.column("b").to_pylist():
                data |= np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["s", "b"])

    # Few tasks, so that few arrays are shuffled; each goes through its entries in batches.
    tasks = max(1, min(16, n_entries // 500_000))
    pieces = entries.coalesce(tasks).mapInArrow(turn, "s int, b binary").groupBy("s").applyInArrow(join, "s int, b binary")
    data = np.zeros(bits // 8, np.uint8)
    for row in pieces.collect():
        data[row["s"] * piece : (row["s"] + 1) * piece] = np.frombuffer(bytes(row["b"]), np.uint8)
    return LogFilter(data, bits)


def train(texts: DataFrame) -> tuple[Model, Broadcast, DataFrame, DataFrame]:
    """Model of the training rows ``t``, its lexicon, the counts of all their words (stored), and what documents look up (stored).

    The last has ``key`` and ``gain``: of a pair (v, w) q(v, w) / (C(v) - S(v)), of a word v log10 of (C(v) - S(v)) / C(v).
    """
    spark = texts.sparkSession
    counts = stored(word_counts(texts), "words")
    at_level = counts.groupBy(_level("c").alias("lv")).agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).collect()
    n, v, e = (sum(x) for x in zip((0, 0, 0), *((r["n"], r["v"], r["v"] * r["lv"]) for r in at_level)))
    q = sum(r["v"] * float(middle(np.array(r["lv"]))) for r in at_level)
    # The vocabulary is bounded by HEAD. Lower levels than it reaches are not sorted for it.
    reached = max((r["lv"] for r in at_level if sum(x["v"] for x in at_level if x["lv"] >= r["lv"]) >= HEAD), default=0)
    place = F.row_number().over(Window.orderBy(F.desc("c"), "word")) - 1
    top = stored(counts.filter(_level("c") >= reached).orderBy(F.desc("c"), "word").limit(HEAD).withColumn("first", place.cast("long")), "head")
    known = top.orderBy("first").toArrow()
    head = {w: i for i, w in enumerate(known["word"].to_pylist())}
    exact = known["c"].to_numpy().astype(np.float64)
    # Hashed by Spark: a task of the filter has one Python worker then, not a second one for the hashes.
    keyed = counts.select(word_keys("word").alias("key"), "c")
    single = build_filter(keyed.select("key", _level("c").alias("level")), e)
    lexicon = spark.sparkContext.broadcast(Lexicon(single, head))

    pairs = stored(pair_counts(texts, lexicon, n), "pairs")
    by_level = {r["lv"]: r["n"] for r in pairs.groupBy(_level("c").alias("lv")).agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest, room = LEAST_LEVEL, PAIR_BITS // BITS_PER_ENTRY
    # The lowest levels go as far as the filter has no room; they are looked up instead.
    while lowest <= max(by_level, default=0) and sum(lv * n for lv, n in by_level.items() if lv >= lowest) > room:
        lowest += 1
    n_entries = sum(lv * n for lv, n in by_level.items() if lv >= lowest)
    kept = pairs.filter(_level("c") >= lowest)
    filter_ = build_filter(kept.select("key", _level("c").alias("level")), n_entries, PAIR_BITS)

    # Exact counts of all words a pair may begin with, by number; those of the head by their place.
    beyond = keyed.filter(F.col("c") >= LEAST_PAIRS).select(F.col("key").bitwiseOR(F.lit(-(1 << 63))).alias("first"), "c")
    numbered = beyond.unionByName(top.select("first", "c"))
    firsts = pairs.groupBy("first").agg(F.sum(_middle("c")).alias("s"), F.count(F.lit(1)).alias("t"))
    firsts = stored(firsts.join(numbered, "first"), "firsts")
    sums, kinds = np.zeros(len(head)), np.zeros(len(head))
    of_head = firsts.filter("first >= 0").select("first", "s", "t").toArrow()  # at most HEAD rows
    at = of_head["first"].to_numpy()
    sums[at], kinds[at] = of_head["s"].to_numpy(), of_head["t"].to_numpy()
    every = F.greatest(F.col("c").cast("double"), "s") + F.col("t")
    firsts = firsts.select("first", (every - F.col("s")).alias("left"), every.alias("every"))
    aside = pairs.filter((F.col("first") < 0) | (_level("c") < lowest)).select("key", "first", _middle("c").alias("q"))
    aside = aside.join(firsts.select("first", "left"), "first").select("key", (F.col("q") / F.col("left")).alias("gain"))
    begun = firsts.filter("first < 0").select(F.col("first").alias("key"), F.log10(F.col("left") / F.col("every")).alias("gain"))
    sought = stored(aside.unionByName(begun), "sought")
    whole = not any(lv < lowest for lv in by_level)
    return Model(filter_, exact, (n, v, q), sums, kinds, lowest, whole), lexicon, counts, sought


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` per row of ``docs``.

    Null texts count as empty: one token, the end. A null id counts as empty
    text in the fold. Each row is scored for itself, repeated or not. Without
    any training row every word is unknown. Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == TRAIN_FOLD).alias("held_out"), text_bytes().alias("t"))
    model, lexicon, counts, sought = train(rows.filter("not held_out"))
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored_rows(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        def offsets(at: int) -> pa.Array:
            return pa.array(np.concatenate([[0], np.cumsum([len(o[at]) for o in out])]), pa.int32())

        ws = pa.array([w for o in out for w in o[4]], pa.binary())
        ns = pa.array([n for o in out for n in o[4].values()], pa.int32())
        keys = pa.array(np.concatenate([o[5] for o in out]).view(np.int64))
        ratios = pa.array(np.concatenate([o[6] for o in out]))
        columns = [
            batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
            pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.float64()),
            pa.ListArray.from_arrays(offsets(4), ws), pa.ListArray.from_arrays(offsets(4), ns),
            pa.ListArray.from_arrays(offsets(5), keys), pa.ListArray.from_arrays(offsets(5), ratios),
        ]
        names = ["doc_id", "held_out", "n_tokens", "n_head", "base_head", "score", "ws", "ns", "keys", "ratios"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, end in runs(texts):
                yield scored_rows(batch.slice(begin, end - begin), list(shared.value.score_batch(lexicon.value, texts[begin:end])))

    shape = f"doc_id {kind}, held_out boolean, n_tokens long, n_head long, base_head double, score double, ws array<binary>, ns array<int>"
    shape += ", keys array<long>, ratios array<double>"
    scored = stored(rows.mapInArrow(score, shape).withColumn("row", F.monotonically_increasing_id()), "scored")
    floor = model.n + 0.5 * (model.v + 1)
    rare = scored.select("row", F.explode(F.arrays_zip("ws", "ns")).alias("x")).select("row", F.col("x.ws").alias("word"), F.col("x.ns").alias("k"))
    rare = rare.join(counts, "word", "left").select(
        "row",
        F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0).alias("n"),
        (F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(floor))).alias("base"),
        F.lit(0.0).alias("more"),
    )
    asked = scored.select("row", F.explode(F.arrays_zip("keys", "ratios")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.ratios").alias("r"))
    more = F.when(F.col("r") > 0, F.log10(1 + F.col("gain") * F.col("r"))).otherwise(F.col("gain"))
    found = asked.join(sought, "key").select("row", F.lit(0).alias("n"), F.lit(0.0).alias("base"), more.alias("more"))
    rare = rare.unionByName(found).groupBy("row").agg(F.sum("n").alias("n_rare"), F.sum("base").alias("base_rare"), F.sum("more").alias("more"))
    return scored.drop("ws", "ns", "keys", "ratios").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(model.n)).cast("long").alias("train_tokens"),
        (F.col("base_head") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
