"""Removal of byte strings that occur more than once, by bucket-pointer refinement.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus. Sorting every suffix of a corpus is more than such a rule
needs, so the suffixes are bucketed and refined only where buckets stay large:

1. **Initial q-gram buckets.** Of the q-grams inside a window of ``LENGTH``
   bytes the one of smallest hash is the window's anchor (the leftmost of
   equals). Equal windows have equal anchors at equal offsets, so a bucket of
   anchors with one member holds windows that occur once, and is dropped. An
   anchor stands for the run of consecutive windows that chose it. Runs equal
   in all bytes form a class: with two members, all their windows are repeated.
   One member of each class goes on, if its bucket holds another class.
2. **Refinement by later offsets.** The runs left are cut into strips of windows
   whose anchors lie at nearby offsets. All windows of a strip share a core of
   bytes, and buckets are refined by the number (hash) of that core; buckets of
   one member are dropped, equal strips are classed as before, and one member
   of each class goes on to narrower strips, whose cores reach further.
3. **Bucket-pointer refinement proper.** What is left shares all but a few bytes.
   Its windows are sorted by bucket pointers: positions are bucketed by their
   first bytes; buckets are refined by the bucket numbers at a later offset,
   whose depth is what has been sorted so far, so each round reuses the earlier
   ones and doubles the depth until ``LENGTH`` is covered. A round sorts only
   the positions that the windows still reach.

Counts are aggregated before they are shuffled and a class goes on with one
member, so neither thousands of copies of a text nor a passage found in a third
of all texts meet in one task: a bucket of the last step has at most one member
for each different surrounding of a few bytes.

Ranges found are joined back to their texts, which are cut in a last pass.
Texts are known by 128 bits of hash, so that ids need be neither unique nor
present; hashes of runs and q-grams have 64 bits each and are compared together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_folder
from ..sources.swap import remove
from .common import prepare, stored, text_bytes

LENGTH = 200
GRAM = 32
#: Bytes handled at a time when anchors are chosen: short texts go together, long ones in pieces that overlap, so no window is missed.
PIECE = 1 << 17
#: Stretches cut into strips at a time.
STRETCHES = 1024
#: Windows of a strip, level by level, and bytes that a task sorts at once.
STRIPS = (24, 4)
SORT_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as a piece needs them."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE, np.uint64))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _INVERSE, np.uint64))])
        return self.up[:n], self.down[:n]


_powers = _Powers()
#: Fixed pseudo-random values of the 256 bytes.
_OCTETS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the hash of any stretch follows, and the inverse powers that align it."""
    up, down = _powers.upto(len(data) + 1)
    return np.concatenate([[np.uint64(0)], np.cumsum(_OCTETS[data] * up[: len(data)])]), down


def _hashes(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _mix((sums[ends] - sums[starts]) * down[starts])


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: minima of 2, 4, 8, ... values, the last two may overlap."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        x = np.minimum(x[:-step], x[step:])
        reach += step
    return x


def anchors(data: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, in pieces of ``sizes`` bytes (``length`` at least) that stand one after the other.

    Piece, hash of the anchor's q-gram, hash of the run, first window in the piece, windows, offset of the anchor.
    """
    sums, down = _sums(data)
    places = len(data) - gram + 1
    grams = _mix((sums[gram:] - sums[:-gram]) * down[:places])
    low = np.uint64(PIECE * 2 - 1)
    least = _slide_min((grams & ~low) | np.arange(places, dtype=np.uint64), length - gram + 1)
    begins = np.cumsum(sizes) - sizes
    stops = begins + sizes - length + 1
    # Runs end where the anchor changes and where pieces end; windows across two pieces are dropped.
    edges = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, begins, stops]))
    first, count = edges[:-1], np.diff(edges)
    piece = np.searchsorted(begins, first, "right") - 1
    inside = first < stops[piece]
    piece, first, count = piece[inside], first[inside], count[inside]
    anchor = (least[first] & low).astype(np.int64)
    runs = _hashes(sums, down, first, first + count + length - 1)
    # The place of the anchor in the run tells apart runs of equal bytes but different anchors.
    runs = _mix(runs + (anchor - first).astype(np.uint64) * _BASE)
    return piece, grams[anchor], runs, first - begins[piece], count, anchor - first


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Number of the text, start and bytes of pieces, as many together as ``PIECE`` allows."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[start : start + PIECE + length - 1]
            if held and size + len(part) > PIECE + length - 1:
                yield held
                held, size = [], 0
            held.append((i, start, part))
            size += len(part)
    if held:
        yield held


def _anchor_rows(length: int, gram: int):
    names = ["gram", "run", "k1", "k2", "first", "windows", "offset"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for held in _pieces(batch.column(2).to_pylist(), length):
                text, start = (np.array([h[i] for h in held], np.int64) for i in (0, 1))
                data = np.frombuffer(b"".join([h[2] for h in held]), np.uint8)
                sizes = np.array([len(h[2]) for h in held], np.int64)
                piece, grams, runs, first, count, offset = anchors(data, sizes, length, gram)
                columns = [
                    grams.view(np.int64), runs.view(np.int64), k1[text[piece]], k2[text[piece]],
                    first + start[piece], count.astype(np.int32), offset.astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return rows


ANCHORS = "gram long, run long, k1 long, k2 long, first long, windows int, offset int"


def refine(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bucket numbers of the strings of ``length`` bytes at ``starts``: equal numbers for equal strings.

    Positions get buckets by their first eight bytes. Round by round a bucket
    is refined by the bucket of the position as many bytes later as have been
    sorted. Each round sorts only the positions that a later one looks at, so
    far fewer than ``data`` has.
    """
    depth, steps = min(8, length), []
    while depth < length:
        # The last step may overlap what is sorted: the depth need not pass the length.
        steps.append(min(depth, length - depth))
        depth += steps[-1]
    asked = np.zeros(len(data) + 1, bool)
    asked[starts] = True
    rounds = [np.flatnonzero(asked)]
    for step in reversed(steps):
        asked[rounds[-1] + step] = True
        rounds.append(np.flatnonzero(asked))
    at = rounds.pop()
    word = np.zeros(len(at), np.uint64)
    for i in range(min(8, length)):
        word = word << np.uint64(8) | data[at + i]
    pointer = np.zeros(len(asked), np.uint64)
    pointer[at] = np.unique(word, return_inverse=True)[1]
    for step in steps:
        at = rounds.pop()
        pairs = pointer[at] * np.uint64(len(asked)) + pointer[at + step]
        pointer[at] = np.unique(pairs, return_inverse=True)[1]
    return pointer[starts].astype(np.int64)


STRIP_ROWS = "gram long, strip int, core long, whole long, run long, lead int, windows int, offset int, bytes binary"


def _strips(length: int, width: int):
    """Cut stretches into strips of ``width`` offsets of the anchor.

    Of stretches come the bytes that hold them, then for each the number of its bytes, its start in them and its
    gram, run, lead, windows and offset.
    """
    names = ["gram", "strip", "core", "whole", "run", "lead", "windows", "offset", "bytes"]
    number = xxhash.xxh64_intdigest

    def hashes(values: Iterable[int]) -> np.ndarray:
        return np.fromiter(values, np.uint64).view(np.int64)

    def cut(texts: list[bytes], of: np.ndarray, start: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
        gram, run, lead, windows, offset = more
        # The window i after the first of the stretch has its anchor at offset - i.
        low = offset - (windows - 1)
        strips = offset // width - low // width + 1
        row = np.repeat(np.arange(len(of)), strips)
        at = low[row] // width + np.arange(len(row)) - np.repeat(np.cumsum(strips) - strips, strips)
        top, bottom = np.minimum(offset[row], at * width + width - 1), np.maximum(low[row], at * width)
        skip, n = offset[row] - top, top - bottom + 1
        begin = start[row] + skip
        owners = of[row].tolist()
        parts = [texts[i][a:b] for i, a, b in zip(owners, begin.tolist(), (begin + n + length - 1).tolist())]
        # Bytes that every window of a full strip covers, as seen from this one.
        shift = top - at * width
        core = hashes(number(p[a:b], 0) for p, a, b in zip(parts, shift.tolist(), (shift + length - width + 1).tolist()))
        whole = hashes(number(p, seed) for p, seed in zip(parts, (top * 65536 + bottom).tolist()))
        small = (x.astype(np.int32) for x in (lead[row] + skip, n, top))
        columns = [gram[row], at.astype(np.int32), core, whole, run[row], *small, pa.array(parts, pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def several(texts: list[bytes], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = [c.astype(np.int64) for c in columns]
        for i in range(0, len(columns[0]), STRETCHES):
            yield cut(texts, *(c[i : i + STRETCHES] for c in columns))

    return several


def _strips_of_runs(length: int, width: int):
    """The strips of a text's runs: rows (t, runs)."""
    strips = _strips(length, width)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(1)
            of = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy())
            gram, run, first, windows, offset = (c.to_numpy() for c in runs.flatten().flatten())
            yield from strips(batch.column(0).to_pylist(), of, first, gram, run, np.zeros_like(of), windows, offset)

    return rows


def _strips_of_strips(length: int, width: int):
    """Narrower strips of strips: rows (bytes, gram, run, lead, windows, offset)."""
    strips = _strips(length, width)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.arange(batch.num_rows)
            yield from strips(batch.column(0).to_pylist(), of, np.zeros_like(of), *(c.to_numpy() for c in batch.columns[1:]))

    return rows


def settle(group: list[tuple], length: int) -> list[tuple[int, int, int, int]]:
    """Repeated windows of strips (gram, run, lead, windows, bytes, more) as (gram, run, first window, windows)."""
    sizes = np.array([len(g[4]) for g in group])
    counts = np.array([g[3] for g in group])
    owner = np.repeat(np.arange(len(group)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(sizes) - sizes)[owner] + within
    same = refine(np.frombuffer(b"".join([g[4] for g in group]), np.uint8), starts, length)
    # Equal strings have one anchor, so they lie in one bucket; a run holds a string once only.
    repeated = np.bincount(same)[same] > 1
    flags = np.concatenate([[False], repeated, [False]])
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    opens = np.flatnonzero(repeated & (new | ~flags[:-2]))
    last = np.concatenate([new[1:], [True]])
    closes = np.flatnonzero(repeated & (last | ~flags[2:]))
    return [
        (group[o][0], group[o][1], group[o][2] + a, n)
        for o, a, n in zip(owner[opens].tolist(), within[opens].tolist(), (closes - opens + 1).tolist())
    ]


def _sort_strips(length: int, limit: int):
    """Strips (gram, run, lead, windows, bytes, strip, core), buckets together, to stretches of repeated windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def close() -> pa.RecordBatch:
            found = settle(held, length)
            columns = list(zip(*found)) if found else [[], [], [], []]
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["gram", "run", "lead", "windows"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                bucket = row[0], row[5], row[6]
                if size >= limit and bucket != last:
                    yield close()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = bucket
        if held:
            yield close()

    return rows


def _several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)


def _one(*columns: str) -> list[Column]:
    """The columns of one row of a group; a hash aggregate holds them, as it does not the least of a struct."""
    return [F.first(c).alias(c) for c in columns]


def _held(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` stored in a folder of its own, and that folder, to be removed as soon as nothing reads it any more."""
    with scratch_folder(df.sparkSession, name) as path:
        return stored(df, name), path


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``k1``, ``k2``, ``ranges`` (start, end in bytes) of the texts ``t`` known as ``k1``, ``k2`` that hold repeated strings (stored).

    Rows that are equal in all columns are occurrences of their own. Each table goes once those made from it are stored.
    """
    spark = texts.sparkSession
    found, found_at = _held(texts.select("k1", "k2", "t").mapInArrow(_anchor_rows(length, gram), ANCHORS), "anchors")
    held, held_at = _held(found.join(_several(found, ["gram"]), "gram", "left_semi"), "buckets")
    remove(spark, found_at)
    members = F.count(F.lit(1)).alias("members")
    classes, classes_at = _held(held.groupBy("gram", "run").agg(members, *_one("k1", "k2", "first", "windows", "offset")), "classes")
    mark = classes.filter("members > 1").select("gram", "run", F.lit(0).alias("lead"), "windows")
    marks = [_held(mark, "marks")]

    vary = classes.join(_several(classes, ["gram"]), "gram", "left_semi")
    wanted = vary.select("k1", "k2", F.struct("gram", "run", "first", "windows", "offset").alias("r"))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list("r").alias("runs"))
    # One row of each text: copies are dropped in their tasks, before the shuffle that the join needs anyway.
    turn = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))
    once = texts.select("k1", "k2", "t", turn.alias("turn")).filter("turn = 1")
    rows = once.join(wanted, ["k1", "k2"]).select("t", "runs")

    bucket, read, cut = ["gram", "strip", "core"], [classes_at], _strips_of_runs
    for width in STRIPS:
        strips, strips_at = _held(rows.mapInArrow(cut(length, width), STRIP_ROWS), "strips")
        for path in read:
            remove(spark, path)
        kinds, kinds_at = _held(strips.groupBy(*bucket, "whole").agg(members, *_one("run", "lead")), "kinds")
        read = [strips_at, kinds_at]
        full = kinds.filter("members > 1").select(*bucket, "whole")
        marks.append(_held(strips.join(full, [*bucket, "whole"], "left_semi").select("gram", "run", "lead", "windows"), "marks"))
        left = kinds.join(_several(kinds, bucket), bucket, "left_semi").select(*bucket, "run", "lead")
        left = strips.join(left, [*bucket, "run", "lead"], "left_semi")
        rows, cut = left.select("bytes", "gram", "run", "lead", "windows", "offset"), _strips_of_strips

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.select("gram", "run", "lead", "windows", "bytes", "strip", "core").repartition(tasks, *bucket)
    dealt = dealt.sortWithinPartitions(*bucket)
    marks.append(_held(dealt.mapInArrow(_sort_strips(length, SORT_BYTES), "gram long, run long, lead int, windows int"), "marks"))
    for path in read:
        remove(spark, path)

    marked = reduce(DataFrame.unionByName, [df for df, _ in marks])
    spans = held.select("gram", "run", "k1", "k2", "first").join(marked, ["gram", "run"])
    start = F.col("first") + F.col("lead")
    span = F.struct(start.alias("a"), (start + F.col("windows") - 1 + length).alias("b"))
    ranges = stored(spans.groupBy("k1", "k2").agg(F.collect_set(span).alias("ranges")), "ranges")
    for path in (held_at, *(path for _, path in marks)):
        remove(spark, path)
    return ranges


def merged(of: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges from ``a`` to ``b`` of the texts ``of``, joined where they touch or overlap, in order."""
    order = np.lexsort((a, of))
    of, a, b = of[order], a[order], b[order]
    # Ends of later texts lie above all of earlier ones.
    far = of * (int(b.max(initial=0)) + 1)
    reach = np.maximum.accumulate(far + b)
    opens = np.flatnonzero(np.concatenate([[True], far[1:] + a[1:] > reach[:-1]])[: len(of)])
    closes = np.append(opens, len(of))[1:] - 1
    return of[opens], a[opens], (reach - far)[closes]


def keep(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The text without the ranges, which are apart and in order."""
    parts, at = [], 0
    for a, b in ranges:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (binary) per row of ``docs``.

    Matches never cross texts; a string repeated within one text counts, and
    overlapping occurrences do. Null texts count as empty, texts shorter than
    ``length`` stay whole; equal texts of ``length`` bytes or more go entirely.
    Ids may be null or repeated, each row being a text of its own. Other
    columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    t = text_bytes()
    texts = docs.select("doc_id", F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2"), t.alias("t"))
    ranges = repeated_ranges(texts.filter(F.octet_length("t") >= length), length, gram)

    @F.arrow_udf("struct<kept:binary,n_removed:long,n_spans:long>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        sizes = pc.fill_null(spans.value_lengths(), 0).to_numpy()
        rows = np.repeat(np.arange(len(sizes)), sizes)
        of, a, b = merged(rows, *(c.to_numpy().astype(np.int64) for c in spans.flatten().flatten()))
        n_spans = np.bincount(of, minlength=len(sizes))
        ends = np.cumsum(n_spans)
        gone = np.concatenate([[0], np.cumsum(b - a)])
        ranges = list(zip(a.tolist(), b.tolist()))
        kept = [
            keep(text, ranges[end - n : end]) if n else text
            for text, n, end in zip(texts.to_pylist(), n_spans.tolist(), ends.tolist())
        ]
        columns = [pa.array(kept, pa.binary()), pa.array(gone[ends] - gone[ends - n_spans]), pa.array(n_spans)]
        return pa.StructArray.from_arrays(columns, names=["kept", "n_removed", "n_spans"])

    # Texts without a repeat stay as they are and never leave the JVM.
    touched = F.when(F.col("ranges").isNotNull(), F.col("t"))
    joined = texts.join(ranges, ["k1", "k2"], "left").select("doc_id", "t", cut(touched, "ranges").alias("c"))
    kept = F.coalesce("c.kept", "t")
    return joined.select(
        "doc_id",
        F.octet_length("t").cast("long").alias("n_bytes"),
        F.coalesce("c.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("c.n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
        kept.alias("kept"),
    )
