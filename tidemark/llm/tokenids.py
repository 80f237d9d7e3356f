"""Token ids in files: frequency-ranked ids in a byte-aligned variable-length code.

A file is Parquet with one row per block of consecutive documents. Every id is
replaced by its rank in the corpus (0: the most frequent), written in as few
bytes as it needs; the byte lengths go, two bits a value, into control bytes of
their own. Readers look a control byte up in a table of 256 rows to get four
lengths at once, so a block is decoded by array operations alone.

Steps: tokenise where the texts lie; count ids per task and then per id (the
table of ranks has one row per vocabulary entry); range-partition the token
arrays by document order; encode each range into blocks.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import prepare, stored

END_ID = 2
#: Ids gathered before a block is closed.
BLOCK_IDS = 1 << 18
#: Pieces after which a worker sets its memory of ids aside; what it set aside before is forgotten.
REMEMBERED = 500_000
#: Code points of text a worker gathers before it encodes them together.
TOGETHER = 4 << 20


def id_type(vocabulary: int) -> np.dtype:
    """Little-endian type of the ids of a vocabulary between tasks."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


_LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.int64)

BLOCK_SCHEMA = (
    "part int, block long, doc_ids binary, nulls binary, doc_tokens binary, n_ids long, control binary, data binary"
)


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative values below 2**32."""
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    width = int(lengths.max(initial=1))
    octets = ranks.view(np.uint8).reshape(-1, 4)[:, :width]
    return control.tobytes(), octets[np.arange(width) < lengths[:, None]].tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind control and data bytes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths) - lengths
    octets = np.frombuffer(data, np.uint8)
    values = octets[starts].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        if not len(longer):
            break
        values[longer] |= octets[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return values


#: White space other than single spaces and line feeds.
_UNCUT = ["  ", "\n\n", " \n", "\n ", *(c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n")]

_UNSHOWN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
#: How a byte-level vocabulary shows each byte: those that do not print take the code points from 256 on, in order.
_SHOWN = "".join(chr(256 + _UNSHOWN.index(b)) if b in _UNSHOWN else chr(b) for b in range(256))
_SPACE = _SHOWN[0x20]


class _Encoder:
    """Token ids of texts, with a bounded memory for the ids of pieces seen before.

    Where white space is single spaces and line feeds between other characters,
    a space begins a new piece for a byte-level tokenizer and a line feed is a
    piece of its own, so such a text may be cut there; a comma or full stop
    after a letter is a piece of its own too. Texts are cut and their pieces
    told apart by Arrow; new words of letters alone go straight to the
    tokenizer's model, other new pieces to the tokenizer many at a time, with
    line feeds between them: one token each, at which the ids are cut again.
    Any other text is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.feed = self._plain(["\n"])[0]
        self.cuts = len(self.feed) == self.dtype.itemsize
        self.points = {p: self._plain([p])[0] for p in (",", ".")}
        parts = json.loads(self.tokenizer.to_str())
        before = parts["pre_tokenizer"] or {}
        self.direct = (
            parts["normalizer"] is None and parts["model"]["type"] == "BPE" and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before["add_prefix_space"]
        )
        self.model = self.tokenizer.model
        vocabulary = np.arange(max(self.tokenizer.get_vocab().values(), default=0) + 1).astype(self.dtype)
        self.bytes_of = [i.tobytes() for i in vocabulary]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _pieces(self, pieces: list[str], before: str) -> list[bytes]:
        """Ids of pieces, each after ``before``."""
        out: list[bytes] = []
        feed, width = np.frombuffer(self.feed, self.dtype)[0], self.dtype.itemsize
        runs = [before + f"\n{before}".join(pieces[i : i + 4000]) + "\n" for i in range(0, len(pieces), 4000)]
        for encoded in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False):
            ids = np.array(encoded.ids, self.dtype)
            blob, start = ids.tobytes(), 0
            for stop in (np.flatnonzero(ids == feed) * width).tolist():
                out.append(blob[start:stop])
                start = stop + width
        return out

    def _word(self, piece: str) -> bytes | None:
        """Ids of a piece that is one word of letters; None for any other.

        Letters of Latin-1 only: of these all versions of Unicode agree that
        they are letters.
        """
        first = piece[:1] == "\n"
        letters = piece[1:] if first else piece
        if not letters.isalpha():
            return None
        if not letters.isascii():
            if max(letters) > "\xff":
                return None
            letters = codecs.charmap_decode(letters.encode(), "strict", _SHOWN)[0]
        tokens = self.model.tokenize(letters if first else _SPACE + letters)
        ids = b"".join([self.bytes_of[t.id] for t in tokens])
        return self.feed + ids if first else ids

    def _learn(self, unseen: list[str]) -> None:
        """Ids of pieces; those that begin a line are marked by the line feed before them."""
        known, older, points = self.known, self.older, self.points
        rest = []
        known["\n"] = self.feed
        for p in unseen:
            ids = older.get(p)
            if ids is None and self.direct:
                if (point := points.get(p[-1:])) is None:
                    ids = self._word(p)
                else:
                    stem = p[:-1]
                    ids = known.get(stem) or older.get(stem)
                    if ids is None and (ids := self._word(stem)) is not None:
                        known[stem] = ids
                    ids = None if ids is None or not stem[-1:].isalpha() else ids + point
            if ids is None:
                rest.append(p)
            else:
                known[p] = ids
        inner = [p for p in rest if p[0] != "\n"]
        first = [p for p in rest if p[0] == "\n" and len(p) > 1]
        known.update(zip(inner, self._pieces(inner, " ")))
        known.update(zip(first, [self.feed + ids for ids in self._pieces([p[1:] for p in first], "")]))

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that may be cut."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        lines = pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string())
        cut = pc.split_pattern(lines, " ")
        pieces = cut.values.dictionary_encode()
        # No piece holds a space: one join and one split make Python strings of all.
        row = pa.ListArray.from_arrays(pa.array([0, len(pieces.dictionary)], pa.int32()), pieces.dictionary)
        distinct = pc.binary_join(row, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        known = self.known
        self._learn([p for p in distinct if p not in known])
        blobs = list(map(known.__getitem__, distinct))
        sizes = np.zeros(len(blobs) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)), out=sizes[1:])
        buffers = [None, pa.py_buffer(sizes), pa.py_buffer(b"".join(blobs))]
        joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(blobs), buffers).take(pieces.indices)
        at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][cut.offsets.to_numpy()].tolist()
        data, width = memoryview(joined.buffers()[2]), self.dtype.itemsize
        return [bytes(data[a + width : b]) for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        cut, whole = [], []
        for i, text in enumerate(texts):
            (cut if self._cuttable(text) else whole).append(i)
        for some, ids in ((cut, self._cut), (whole, self._plain)):
            if some:
                for i, blob in zip(some, ids([texts[i] for i in some])):
                    out[i] = blob
        return out

    def _cuttable(self, text: str) -> bool:
        return self.cuts and not (
            text[:1].isspace() or text[-1:].isspace() or any(s in text for s in _UNCUT) or any(s in text for s in self.special)
        )


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[list[str], pa.RecordBatch]]]:
    """Batches with their texts, several at a time until these are ``TOGETHER`` long."""
    group, size = [], 0
    for batch in batches:
        texts = batch.column(2).to_pylist()
        group.append((texts, batch))
        size += sum(map(len, texts))
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def tokenized(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """A row per document (``doc_id``, ``tie``, ``ids``) and rows that only count: ``counts`` of the ids of a task's batches.

    ``ids`` are little-endian, of 16 or 32 bits by the vocabulary; ``tie`` is a
    digest of the text; ``counts`` are 64-bit, one per id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        tail = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
        total, names = np.zeros(0, np.int64), ["doc_id", "tie", "ids", "counts"]
        key = pa.int64()
        for group in _together(batches):
            blobs = [b + tail for b in encoder.encode([t for texts, _ in group for t in texts])]
            n = np.bincount(np.frombuffer(b"".join(blobs), encoder.dtype), minlength=len(total))
            n[: len(total)] += total
            total, done = n, 0
            for texts, batch in group:
                own, done, key = blobs[done : done + len(texts)], done + len(texts), batch.schema.field(0).type
                none = pa.nulls(len(own), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary()), none], names=names)
        if len(total):
            empty = [pa.nulls(1, key), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    texts = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(ids, f"doc_id {kind}, tie long, ids binary, counts binary")


def id_counts(counts: DataFrame) -> DataFrame:
    """``id``, ``n`` from the ``counts`` of all tasks; a task hands on at most one row per vocabulary entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                n = np.frombuffer(blob, "<i8").copy()
                longer, shorter = (n, total) if len(n) >= len(total) else (total, n)
                longer[: len(shorter)] += shorter
                total = longer
        present = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(total[present])], names=["id", "n"])

    return counts.mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID) -> np.ndarray:
    """Write the ids of ``docs`` in ascending ``doc_id`` order below ``path``; returns the id of each rank."""
    spark = prepare(docs.sparkSession)
    both = stored(tokenized(docs, tokenizer, end_id), "tokens")
    tokens = both.filter("ids is not null").select("doc_id", "tie", "ids")
    # One entry per id of the vocabulary, whatever the corpus.
    counts = id_counts(both.filter("counts is not null").select("counts")).toPandas().sort_values(["n", "id"], ascending=[False, True])
    by_rank = counts["id"].to_numpy(np.uint32)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The tokenizer stays with the tasks: they hold it already, the driver never needs it.
        dtype = _encoder(tokenizer).dtype
        part, block, held, blobs, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(blobs), dtype)
            control, data = encode_block(shared.value[ids])
            row = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([block], pa.int64()),
                "doc_ids": pa.array([np.array([d or 0 for d in held], "<i8").tobytes()], pa.binary()),
                "nulls": pa.array([np.array([d is None for d in held], np.uint8).tobytes()], pa.binary()),
                "doc_tokens": pa.array([np.array([len(b) // dtype.itemsize for b in blobs], "<u8").tobytes()], pa.binary()),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "control": pa.array([control], pa.binary()),
                "data": pa.array([data], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(doc)
                blobs.append(blob)
                size += len(blob) // dtype.itemsize
                if size >= BLOCK_IDS:
                    yield close()
                    block, held, blobs, size = block + 1, [], [], 0
        if held:
            yield close()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(tasks, F.asc_nulls_first("doc_id"), "tie")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie").select("doc_id", "ids")
    ordered.mapInArrow(encode, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/blocks")
    table = spark.createDataFrame(counts.assign(rank=range(len(counts)))[["rank", "id", "n"]], "rank long, id long, n long")
    table.coalesce(1).write.option("compression", "zstd").parquet(f"{path}/ranks")
    return by_rank


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below ``path``: ``doc_id``, ``part``, ``block``, ``at`` (place in the block), ``ids`` (binary)."""
    prepare(spark)
    ranks = spark.read.parquet(f"{path}/ranks").toPandas().sort_values("rank")
    shared = spark.sparkContext.broadcast(ranks["id"].to_numpy(np.uint32))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = decode_block(row["control"], row["data"], row["n_ids"])
                ids = shared.value[values].astype("<u4")
                ends = np.cumsum(np.frombuffer(row["doc_tokens"], "<u8").astype(np.int64))
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                docs = np.frombuffer(row["doc_ids"], "<i8")
                nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, mask=nulls),
                        pa.array(np.full(n, row["part"], np.int32)),
                        pa.array(np.full(n, row["block"], np.int64)),
                        pa.array(starts),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    names=["doc_id", "part", "block", "at", "ids"],
                )

    # A block is a row of its own size, so few of them go to a worker at a time.
    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.mapInArrow(decode, "doc_id long, part int, block long, at long, ids binary")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID, path: str | None = None) -> DataFrame:
    """Write ``docs`` as id files, read the files back and return per document what is in them.

    Columns: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` (with the end id), ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit integers). Null texts count as empty. Documents stand in
    ascending ``doc_id`` order, null ids first, equal ids in order of a digest
    of their texts; each row of ``docs`` is a document, repeated or not. Other
    columns are ignored; an empty table gives empty files and no rows.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "n_ids")
    # Ids before a block: within its part along the blocks, and all of the parts before.
    along = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(along), F.lit(0)).alias("base")).join(parts, "part")
    starts = starts.select("part", "block", (F.col("base") + F.col("earlier")).alias("base"))
    read = read_ids(spark, path).select(
        "doc_id", "part", "block", "at", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    return read.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
