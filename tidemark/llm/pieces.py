"""SentencePiece encoding and decoding of merge-type (BPE) models from a prefix table.

Merging joins the best-scored neighbours first, leftmost among equals. Its result
is known prefix by prefix: the encoding of a prefix ends in one token only, and
that is the one token that ends there, begins where some shorter prefix ends, and
bears the neighbour which that prefix ends in. So the table stores one token per
prefix. An Aho-Corasick automaton names the tokens that end at each place, a test
of two tokens picks the right one, and the ids are read backwards from the end.

Two tokens bear each other if merging their joined text gives the two again. The
merges of either alone happen in a fixed order, and only the symbols next to the
border matter between them: the two orders are walked together, best score first,
and the pair fails once the symbols at the border would merge before the next
merge on either side. Tests are remembered per worker.

No token holds a space sign after another character, nor a character that the
model lacks, so texts fall into words that are encoded by themselves. This is read
off the model; where it does not hold, whole texts are encoded in one go. Recent
words are remembered per worker, at most ``WORDS`` of them.

Characters without a token become the byte tokens of their UTF-8 bytes. Decoding
gathers the bytes of all tokens of a batch at once, drops the space that encoding
puts before a text, and writes U+FFFD for each byte that is no part of a character.

Odd rows: a null text counts as empty and gets the end id alone; a null list of
ids decodes as empty; repeated rows give equal results; an empty table gives an
empty table; columns other than those named are ignored. The model file must be
readable at the same path on every executor.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from .common import prepare

SPACE = "▁"

#: Words and pairs of tokens a worker remembers before it starts afresh, and the longest such word.
WORDS = 300_000
PAIRS = 500_000
LONGEST = 64


class Merges:
    """Scores of a merge-type vocabulary and what follows from them for tokens next to each other."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self._alone: dict[str, tuple[tuple[float, str, str], ...]] = {}

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Symbols of a text after all merges, and each merge: its score, the first and the last symbol after it."""
        symbols, steps, score = list(text), [], self.scores.get
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[0], symbols[-1]))
        return symbols, steps

    def steps(self, token: str) -> tuple[tuple[float, str, str], ...]:
        found = self._alone.get(token)
        if found is None:
            found = self._alone[token] = tuple(self.merge(token)[1])
        return found

    def bear(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives the two again."""
        ours, theirs = self.steps(left), self.steps(right)
        a, b, i, j = left[-1], right[0], 0, 0
        while True:
            s = self.scores.get(a + b)
            on_left = ours[i][0] if i < len(ours) else None
            on_right = theirs[j][0] if j < len(theirs) else None
            if s is not None and (on_left is None or s > on_left) and (on_right is None or s >= on_right):
                return False
            if on_left is None and on_right is None:
                return True
            if on_right is None or (on_left is not None and on_left >= on_right):
                a, i = ours[i][2], i + 1
            else:
                b, j = theirs[j][1], j + 1


class Words(dict):
    """Ids of recent words as little-endian 32-bit bytes; unknown ones are encoded on the way."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(word), "<i4").tobytes()
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class Model:
    """A merge-type model with byte tokens: encoding of texts and decoding of ids."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.size, self.normalize = size, sp.normalize
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes = {}
        ids: dict[str, int] = {}
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif sp.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not sp.is_control(i) and not sp.is_unknown(i):
                ids[piece] = i
        if len(self.bytes) != 256:
            raise ValueError("the model needs a token for every byte")
        self.merges = Merges({p: sp.get_score(i) for p, i in ids.items()})
        self.letters = set().union(*ids)
        # Characters of tokens that are no token themselves take part in merges under ids of their own.
        self.extra = {size + k: c for k, c in enumerate(sorted(self.letters - ids.keys()))}
        self.names = dict(enumerate(pieces)) | self.extra
        self.automaton = ahocorasick.Automaton()
        for piece, i in [*ids.items(), *((c, k) for k, c in self.extra.items())]:
            if len(piece) == 1 or len(self.merges.merge(piece)[0]) == 1:
                self.automaton.add_word(piece, (i, len(piece) - 1))
        self.automaton.make_automaton()
        self.split = self._splitter(ids)
        self.words = Words(self.encode_word)
        self.pairs: dict[int, bool] = {}
        self._decoding(sp, pieces)

    def _splitter(self, ids: dict[str, int]):
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            return None
        if "\n" in self.letters:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        return re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall

    def encode_word(self, word: str) -> list[int]:
        """Ids of a normalised text."""
        if self.letters.issuperset(word):
            return self._encode_known(word)
        out: list[int] = []
        at = 0
        for i, c in enumerate(word):
            if c not in self.letters:
                out += self._encode_known(word[at:i])
                out += [self.bytes[b] for b in c.encode()]
                at = i + 1
        return out + self._encode_known(word[at:])

    def _bear(self, pair: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[pair] = self.merges.bear(self.names[pair >> 20], self.names[pair & 0xFFFFF])
        return found

    def _encode_known(self, word: str) -> list[int]:
        last, done, known = [-1], -1, self.pairs.get
        for end, (token, inner) in self.automaton.iter(word):
            if end == done:
                continue
            begin = end - inner
            if begin:
                pair = last[begin] << 20 | token
                bears = known(pair)
                if bears is None:
                    bears = self._bear(pair)
                if not bears:
                    continue
            last.append(token)
            done = end
        ids, at = [], len(word)
        while at:
            token = last[at]
            name = self.names[token]
            if token < self.size:
                ids.append(token)
            else:
                ids.extend(self.bytes[b] for b in reversed(name.encode()))
            at -= len(name)
        ids.reverse()
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without an end id."""
        text = self.normalize(text) if text else ""
        parts = self.split(text) if self.split else ([text] if text else [])
        found = b"".join(map(self.words.__getitem__, parts))
        if len(self.words) > WORDS:
            self.words.clear()
        return np.frombuffer(found, "<i4")

    def _decoding(self, sp, pieces: list[str]) -> None:
        surface = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                surface.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i):
                surface.append(b"")
            elif sp.is_unknown(i):
                surface.append(sp.decode([i]).encode())
            else:
                surface.append(piece.replace(SPACE, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.is_byte = np.array([sp.is_byte(i) for i in range(len(pieces))])
        self.is_control = np.array([sp.is_control(i) for i in range(len(pieces))])
        self.prefixed = sp.normalize("a") != "a"
        self.spaced = np.array([p.startswith(SPACE) and not sp.is_control(i) for i, p in enumerate(pieces)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 texts of the lists of ids that begin and end at ``offsets``."""
        lengths, places = self.lengths[ids], self.places[ids]
        if self.prefixed:
            seen = np.flatnonzero(~self.is_control[ids])
            first = np.searchsorted(seen, offsets[:-1])
            first = seen[first[first < len(seen)]]
            first = np.unique(first[self.spaced[ids[first]]])
            lengths[first] -= 1
            places[first] += 1
        ends = np.cumsum(lengths)
        gathered = np.repeat(places - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        data = self.surface[gathered].tobytes()
        bounds = np.concatenate(([0], ends))
        stops = bounds[offsets].tolist()
        texts = [data[a:b] for a, b in zip(stops, stops[1:])]
        held = np.searchsorted(offsets, np.flatnonzero(self.is_byte[ids]), "right") - 1
        controls = np.flatnonzero(self.is_control[ids])
        for i in np.unique(held).tolist():
            # Bytes on two sides of a control token make no character together.
            low, high = np.searchsorted(controls, (offsets[i], offsets[i + 1] - 1))
            cuts = [stops[i], *bounds[controls[low:high]].tolist(), stops[i + 1]]
            texts[i] = b"".join(_mended(data[a:b]) for a, b in zip(cuts, cuts[1:]))
        return texts


def _mended(data: bytes) -> bytes:
    """U+FFFD in place of each byte that begins no whole character."""
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(data[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out).encode()


_models: dict[str, Model] = {}


def load(path: str) -> Model:
    """The model at ``path``, loaded once per worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encoded(docs: DataFrame, path: str, end_id: int | None = 2) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs (doc_id, text)``; ``end_id`` follows the ids of each text."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    end = np.array([] if end_id is None else [end_id], "<i4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            lists = []
            for text in batch.column("text"):
                lists += (model.encode(text.as_py()), end)
            offsets = np.concatenate(([0], np.cumsum([len(a) + len(b) for a, b in zip(lists[::2], lists[1::2])])))
            flat = np.concatenate(lists) if lists else end[:0]
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.record_batch([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of every row of ``rows (doc_id, ids)``."""
    prepare(rows.sparkSession)
    kept = rows.select("doc_id", "ids")
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            texts = model.decode(np.asarray(lists.flatten()), offsets)
            yield pa.record_batch([batch.column("doc_id"), lists, pa.array(texts, pa.binary())], names=schema.names)

    return kept.mapInArrow(run, schema).withColumn("text", F.col("text").cast("string"))


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of the text they decode to."""
    both = decoded(encoded(docs, path), path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
