"""Phrase collocations, counted in HAT-tries.

Each task counts the phrases of its texts in one trie per language. Inner nodes
are keyed by word ids; at the edge hang hash containers that map the rest of a
phrase to its count. A container that grows beyond ``BURST`` entries bursts: words
that begin many of its phrases get containers of their own one level below, the
others stay together. Once a task holds more than ``ROOM`` entries, the largest
subtrees leave it whole, each as a run sorted by phrase, and counting goes on
without them. Runs meet by phrase in one shuffle, where their counts are summed;
a phrase comes at most once per run, so a frequent word or pair of words is no hot
key. Word ids are the task's own; runs carry the words.

Counting goes by length. The first pass counts words and pairs. A phrase of three
words is at most as frequent as each of its two pairs, so the second pass counts
only phrases whose pairs both reach the least count. It learns them from a Bloom
filter of at most ``FILTER_BITS`` bits: a false hit costs a row in the shuffle and
nothing else, so a filter too small for its corpus changes no result.

What is left after the shuffle are phrases seen ``least`` times or more. Scores
join these with the counts of their parts, in decimal numbers of 38 digits, which
are exact for counts up to 10^16.

Odd rows: a null text counts as empty, a null language as ``und``; repeated rows
count as often as they come; an empty table gives an empty table; columns other
than ``lang`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, stored, text_bytes

#: Entries at which a container bursts, and entries at which a task sends subtrees away.
BURST = 65_536
ROOM = 1_000_000

#: Word ids take this many bits, so three fit a key; a task starts a new vocabulary before it runs out of them.
ID_BITS = 21
_MASK = (1 << ID_BITS) - 1

#: Bits of the filter of frequent phrases at most.
FILTER_BITS = 1 << 27

#: Bytes of text that are cut into words at a time; a longer text goes alone.
SLICE_BYTES = 4 << 20

#: Rows of one batch of a run.
RUN_ROWS = 1 << 15

# Bytes by class: 0 belongs to a word, 1 is a space or tab, 2 ends a piece.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of texts that lie end to end, and for each word whether it begins a piece."""
    kind = _CLASS[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    letters = _LOWER[data[inside]]
    ends = np.concatenate((np.cumsum(inside)[starts] - 1 if len(starts) else starts, [len(letters)])).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
    )
    breaks = np.sort(np.concatenate((np.flatnonzero(kind == 2), offsets[:-1] - 1)))
    number = np.searchsorted(breaks, starts)
    first = np.ones(len(starts), bool)
    first[1:] = number[1:] != number[:-1]
    return words, first


class Node:
    """A node of the trie: the hash container of its phrases, and nodes of words that left it."""

    __slots__ = ("bag", "below", "limit")

    def __init__(self):
        self.bag: dict[int, int] = {}
        self.below: dict[int, Node] = {}
        self.limit = BURST

    def size(self) -> int:
        return len(self.bag) + sum(n.size() for n in self.below.values())

    def add(self, keys: np.ndarray, counts: np.ndarray, levels: int) -> int:
        """Add counts of sorted, distinct keys of ``levels`` ids each; returns how many entries are new."""
        new = 0
        if self.below:
            shift = ID_BITS * (levels - 1)
            heads = np.array(sorted(self.below), np.int64)
            low, high = np.searchsorted(keys, heads << shift), np.searchsorted(keys, (heads + 1) << shift)
            rest = np.ones(len(keys), bool)
            for i in np.flatnonzero(low < high).tolist():
                part = slice(low[i], high[i])
                rest[part] = False
                new += self.below[int(heads[i])].add(keys[part] & ((1 << shift) - 1), counts[part], levels - 1)
            keys, counts = keys[rest], counts[rest]
        bag = self.bag
        before, held = len(bag), bag.get
        for key, n in zip(keys.tolist(), counts.tolist()):
            bag[key] = held(key, 0) + n
        new += len(bag) - before
        if levels > 1 and len(bag) > self.limit:
            self._burst(levels)
        return new

    def _burst(self, levels: int) -> None:
        shift = ID_BITS * (levels - 1)
        keys = np.fromiter(self.bag, np.int64, len(self.bag))
        heads, sizes = np.unique(keys >> shift, return_counts=True)
        leaving = heads[sizes >= BURST >> 6].tolist()
        for head in leaving:
            self.below[head] = Node()
        nodes, low = self.below, (1 << shift) - 1
        if leaving:
            stay = {}
            for key, n in self.bag.items():
                node = nodes.get(key >> shift)
                if node is None:
                    stay[key] = n
                else:
                    node.bag[key & low] = n
            self.bag = stay
        # Where no single word stands out the container may grow on, up to twice its size.
        self.limit = max(BURST, 2 * len(self.bag))

    def entries(self, levels: int, prefix: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(self.bag)
        yield np.fromiter(self.bag, np.int64, n) | prefix, np.fromiter(self.bag.values(), np.int64, n)
        shift = ID_BITS * (levels - 1)
        for head, node in self.below.items():
            yield from node.entries(levels - 1, prefix | head << shift)


class Counter:
    """Counts of phrases of up to ``longest`` words in one task; what it sends away are sorted runs."""

    def __init__(self, longest: int, with_parts: bool):
        self.longest, self.with_parts = longest, with_parts
        self.ids: dict[bytes, int] = {}
        self.tries: dict[str, Node] = {}
        self.held = 0

    def number(self, words: pa.Array) -> np.ndarray:
        """Ids of distinct words, from 1; 0 stands for the end of a piece."""
        ids = self.ids
        return np.array([ids.setdefault(w, len(ids) + 1) for w in words.to_pylist()], np.int64)

    def add(self, lang: str, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        distinct, counts = np.unique(keys, return_counts=True)
        self.held += self.tries.setdefault(lang, Node()).add(distinct, counts, self.longest)
        if self.held > ROOM:
            yield from self.spill(self.held - ROOM // 2)

    def room_for(self, words: int) -> bool:
        return len(self.ids) + words < _MASK

    def spill(self, least: int | None = None) -> Iterator[pa.RecordBatch]:
        """Send the largest subtrees away until ``least`` entries are gone; all of them by default."""
        subtrees = []
        for lang, root in self.tries.items():
            subtrees.append((len(root.bag), lang, None))
            subtrees += [(node.size(), lang, head) for head, node in root.below.items()]
        subtrees.sort(key=lambda t: -t[0])
        words = pa.array(list(self.ids), pa.large_binary()) if self.ids else None
        # Ranks of the ids in byte order; the end of a piece sorts first.
        rank = np.zeros(len(self.ids) + 1, np.int64)
        if words is not None:
            rank[np.asarray(pc.array_sort_indices(words)) + 1] = np.arange(1, len(self.ids) + 1)
        gone, small = 0, {}
        for size, lang, head in subtrees:
            if least is not None and gone >= least:
                break
            if not size:
                continue
            root = self.tries[lang]
            if head is None:
                node = Node()
                node.bag, root.bag = root.bag, {}
                found = list(node.entries(self.longest))
            else:
                found = list(root.below.pop(head).entries(self.longest - 1, head << ID_BITS * (self.longest - 1)))
            gone += size
            # Subtrees leave in runs of their own unless they are small.
            small.setdefault(lang, []).extend(found)
            if sum(len(k) for k, _ in small[lang]) >= BURST:
                yield from self._run(lang, small.pop(lang), words, rank)
        for lang, found in small.items():
            yield from self._run(lang, found, words, rank)
        self.held -= gone
        if least is None:
            self.ids.clear()
            self.tries.clear()
            self.held = 0

    def _run(self, lang: str, found, words: pa.Array, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([k for k, _ in found])
        counts = np.concatenate([c for _, c in found])
        ids = [keys >> ID_BITS * (self.longest - 1 - i) & _MASK for i in range(self.longest)]
        order = np.lexsort([rank[i] for i in reversed(ids)])
        ids, counts = [i[order] for i in ids], counts[order]
        if self.with_parts and len(counts):
            first = np.flatnonzero(np.concatenate(([True], ids[0][1:] != ids[0][:-1])))
            yield from _rows(lang, [ids[0][first]], np.add.reduceat(counts, first), words)
        whole = ids[-1] > 0
        yield from _rows(lang, [i[whole] for i in ids], counts[whole], words)


def _rows(lang: str, ids: list[np.ndarray], counts: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts), RUN_ROWS):
        parts = [words.take(pa.array(i[at : at + RUN_ROWS] - 1)) for i in ids]
        space = pa.scalar(b" ", pa.large_binary())
        phrases = pc.binary_join_element_wise(*parts, space) if len(parts) > 1 else parts[0]
        n = counts[at : at + RUN_ROWS]
        yield pa.record_batch(
            [pa.array([lang] * len(n), pa.string()), phrases.cast(pa.binary()), pa.array(n, pa.int64())],
            names=["lang", "phrase", "n"],
        )


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Texts of one language at a time, in slices of bounded size."""
    langs = batch.column("lang")
    for lang in langs.unique().to_pylist():
        texts = batch.column("text").filter(pc.equal(langs, lang))
        at = np.concatenate(([0], np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64))))
        begin = 0
        while begin < len(texts):
            end = max(int(np.searchsorted(at, at[begin] + SLICE_BYTES, "right")) - 1, begin + 1)
            part = texts.slice(begin, end - begin)
            raw = np.frombuffer(b"".join(part.to_pylist()), np.uint8)
            yield lang, raw, at[begin : end + 1] - at[begin]
            begin = end


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), 11) & 0xFFFFFFFF
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)


def _pair_bits(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Places of pairs of word hashes in a filter of ``bits`` bits, a power of two."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + (left >> np.uint64(29)))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


_RUN = "lang string, phrase binary, n long"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_bytes().alias("text"))


def _count_runs(docs: DataFrame, longest: int, allowed=None, bits: int = 0) -> DataFrame:
    """Sorted runs ``lang, phrase, n``: words and pairs of all texts, or phrases of three words whose pairs are allowed.

    The row of the empty phrase holds the number of words of a language in a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, totals = Counter(longest, with_parts=allowed is None), {}
        held = None if allowed is None else np.frombuffer(allowed.value, np.uint8)
        for batch in batches:
            for lang, data, offsets in _slices(batch):
                words, first = split_words(data, offsets)
                if not len(words):
                    continue
                totals[lang] = totals.get(lang, 0) + len(words)
                coded = words.dictionary_encode()
                codes = np.asarray(coded.indices).astype(np.int64)
                if not counter.room_for(len(coded.dictionary)):
                    yield from counter.spill()
                # A word and the next one of its piece; 0 behind the last.
                more = np.zeros(len(codes), bool)
                more[:-1] = ~first[1:]
                if held is None:
                    ids = counter.number(coded.dictionary)[codes]
                    following = np.zeros_like(ids)
                    following[:-1] = ids[1:]
                    yield from counter.add(lang, ids << ID_BITS | np.where(more, following, 0))
                    continue
                hashes = _hashes(lang, coded.dictionary)[codes]
                paired = np.flatnonzero(more)
                place = _pair_bits(hashes[paired], hashes[paired + 1], bits)
                frequent = np.zeros(len(codes) + 1, bool)
                frequent[paired] = held[place >> 3] >> (place & 7).astype(np.uint8) & 1
                at = np.flatnonzero(frequent[:-1] & frequent[1:])
                if not len(at):
                    continue
                used, inverse = np.unique(codes[np.stack((at, at + 1, at + 2))], return_inverse=True)
                ids = counter.number(coded.dictionary.take(pa.array(used)))[inverse].reshape(3, -1)
                yield from counter.add(lang, ids[0] << 2 * ID_BITS | ids[1] << ID_BITS | ids[2])
        yield from counter.spill()
        if allowed is None:
            for lang, n in totals.items():
                yield pa.record_batch([pa.array([lang]), pa.array([b""], pa.binary()), pa.array([n], pa.int64())], names=["lang", "phrase", "n"])

    return _texts(docs).mapInArrow(count, _RUN)


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Runs summed by phrase; phrases below ``least`` go, the empty one stays."""
    kept = (F.col("f") >= least) | (F.col("phrase") == F.lit(b""))
    return runs.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(kept)


def _filter(pairs: DataFrame) -> tuple[bytes, int]:
    """Bloom filter of the phrases of two words: its bytes and its number of bits, sized by the number of phrases."""
    n = pairs.count()
    bits = 1 << min(max(16 * n, 1 << 16).bit_length(), FILTER_BITS.bit_length() - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                two = [p.split(b" ") for p in batch.column("phrase").filter(pc.equal(langs, lang)).to_pylist()]
                left, right = (_hashes(lang, pa.array([t[i] for t in two], pa.binary())) for i in (0, 1))
                at = _pair_bits(left, right, bits)
                yield pa.record_batch([pa.array(at >> 6), pa.array((at & 63).astype(np.int32))], names=["word", "bit"])

    one = F.expr("shiftleft(1L, bit)")
    words = pairs.mapInArrow(places, "word long, bit int").groupBy("word").agg(F.bit_or(one).alias("bits")).toArrow()
    filled = np.zeros(bits >> 6, "<i8")
    filled[np.asarray(words["word"])] = np.asarray(words["bits"])
    return filled.tobytes(), bits


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """``lang, phrase, f`` of the words and phrases seen ``least`` times or more; the empty phrase counts all words.

    ``phrase`` is UTF-8 bytes, its words joined by one space.
    """
    if longest not in (2, 3):
        raise ValueError("phrases of two or three words")
    spark = prepare(docs.sparkSession)
    counts = stored(_merged(_count_runs(docs, 2), least), "phrases-2")
    if longest == 2:
        return counts
    allowed, bits = _filter(counts.filter(_length() == 2))
    shared = spark.sparkContext.broadcast(allowed)
    return counts.unionByName(stored(_merged(_count_runs(docs, 3, shared, bits), least), "phrases-3"))


def _length() -> Column:
    """Words of a phrase; none for the empty one."""
    text = F.col("phrase").cast("string")
    return F.when(F.length("phrase") == 0, 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut of lowest
    score ``floor(10^6 a^2 / (l r))``, ``n`` all words of the language. Phrases go
    that lie in a longer one which makes up ``share`` of 100 of their occurrences.
    """
    counted = frequent_phrases(docs, longest, least).withColumn("length", _length())
    counts = counted.filter("length > 0").select("lang", F.col("phrase").cast("string").alias("phrase"), "f", "length")
    totals = counted.filter("length = 0").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ", -1)
    phrases = counts.filter("length > 1").withColumn("words", words)

    def joined(begin: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", begin, size), " ")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "length", "k",
        joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"),
    )
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(
        "(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = (
        phrases.filter("length > 2")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("length") - 1)))
        .withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)))
        .select("lang", joined(F.col("begin"), F.col("size")).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    )
    kept = (
        lowest.join(inner, ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("around") < share * F.col("a"), F.lit(True)))
        .select("lang", "phrase", "a", "cut.*")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The plain row number against a number: Spark then keeps the best of each task before the shuffle by language.
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
