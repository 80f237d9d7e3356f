"""Fill-in-middle transformation: a text is cut twice, and its middle moves to the end.

Cuts count units: ``token`` (a run of ASCII letters, or any other code point) or
``char`` (code points). Texts stay UTF-8 bytes all the way. What turns byte
places into code points and back is a sparse index of the multibyte characters
alone, their places and their bytes beyond the first: stretches of ASCII are
plain arithmetic, and a search among the exceptions settles the rest.

Forms: ``plain`` (text as it is), ``psm`` (prefix, suffix, middle) and ``spm``
(suffix, prefix, middle), each part behind its sentinel. A text that is empty or
holds a sentinel stays plain, so every output can be taken apart again.

Choices follow from the sha256 of ``seed:doc_id`` and nothing else: the same at
every run, whatever the partitioning. Each row is decided by itself, without a
shuffle.

Odd rows: a null text counts as empty; a null id counts as empty text in the
hash; repeated rows give repeated, equal results; an empty table gives an empty
table; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import prepare, text_bytes

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")


class Exceptions:
    """Multibyte characters of UTF-8 bytes: where each begins and the bytes it takes beyond one."""

    def __init__(self, data: np.ndarray):
        self.places = np.flatnonzero(data >= 0xC0)
        leads = data[self.places]
        excess = 1 + (leads >= 0xE0).astype(np.int64) + (leads >= 0xF0)
        #: Bytes beyond one of all exceptions before each, and of all.
        self.before = np.concatenate(([0], np.cumsum(excess)))
        self.chars = self.places - self.before[:-1]

    def to_chars(self, at: np.ndarray) -> np.ndarray:
        """Code points before the byte places ``at``, which begin characters."""
        return at - self.before[np.searchsorted(self.places, at)]

    def to_bytes(self, at: np.ndarray) -> np.ndarray:
        """Byte places of the code points numbered ``at``."""
        return at + self.before[np.searchsorted(self.chars, at)]


def token_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Byte places at which tokens begin; ``begins`` are those at which texts do, so no token runs across two."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    inner = np.zeros(len(data), bool)
    inner[1:] = letter[1:] & letter[:-1]
    inner[begins[begins < len(data)]] = False
    return np.flatnonzero(~inner & ((data & 0xC0) != 0x80))


def cut_places(data: np.ndarray, offsets: np.ndarray, draws: Sequence[np.ndarray], unit: str, index: Exceptions):
    """Units of each text, and the byte places of the cuts after ``draw % (units + 1)`` units, one array per draw."""
    if unit == "token":
        starts = token_starts(data, offsets[:-1])
        first = np.searchsorted(starts, offsets)
    else:
        first = index.to_chars(offsets)
    n = np.diff(first)
    places = []
    for draw in draws:
        units = draw % (n + 1)
        at = first[:-1] + units
        if unit == "token":
            inside = units < n
            place = offsets[1:].copy()
            place[inside] = starts[at[inside]]
        else:
            place = index.to_bytes(at)
        places.append(place)
    return n, places


def _overlap(sentinels: Sequence[str]) -> bool:
    """Whether a sentinel is empty, lies in another, or one's end can be another's (or its own) beginning."""
    for i, a in enumerate(sentinels):
        for j, b in enumerate(sentinels):
            if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                return True
    return False


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _draws(seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20, unit: str = "token", sentinels: Sequence[str] = SENTINELS
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs (doc_id, text)``.

    ``n`` are the units of the text, ``rate`` of 100 texts are transformed and
    ``spm_rate`` of 100 of these begin with the suffix. Lengths count code points
    and are null for plain texts.
    """
    if unit not in ("token", "char"):
        raise ValueError("units are token or char")
    if len(sentinels) != 3 or _overlap(sentinels):
        raise ValueError("give three sentinels of which none overlaps itself or another")
    prepare(docs.sparkSession)
    marks = [s.encode() for s in sentinels]
    p, s, m = marks
    rows = docs.select("doc_id", text_bytes().alias("text"), *_draws(seed))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.BinaryType()),
    ])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("text"))
            h = [np.asarray(batch.column(f"_h{i}")) for i in range(4)]
            index = Exceptions(data)
            n, (one, two) = cut_places(data, offsets, h[:2], unit, index)
            low, high = np.minimum(one, two), np.maximum(one, two)
            prefix_chars = index.to_chars(low) - index.to_chars(offsets[:-1])
            middle_chars = index.to_chars(high) - index.to_chars(low)
            raw = data.tobytes()
            plain, spm = h[2] % 100 >= rate, h[3] % 100 < spm_rate
            forms, outputs = [], []
            for a, x, y, b, keep, back in zip(
                offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist(), plain.tolist(), spm.tolist()
            ):
                text = raw[a:b]
                if keep or not text or p in text or s in text or m in text:
                    forms.append("plain")
                    outputs.append(text)
                elif back:
                    forms.append("spm")
                    outputs.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                else:
                    forms.append("psm")
                    outputs.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
            whole = np.array([f == "plain" for f in forms], bool)
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                    pa.array(prefix_chars, pa.int64(), mask=whole), pa.array(middle_chars, pa.int64(), mask=whole),
                    pa.array(outputs, pa.binary()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(transform, schema).withColumn("output", F.col("output").cast("string"))


def restored(sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that columns ``form`` and ``output`` were made of."""
    parts = F.split("output", "|".join(re.escape(s) for s in sentinels), -1)
    return (
        F.when(F.col("form") == "plain", F.col("output"))
        .when(F.col("form") == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )


def digests(docs: DataFrame) -> DataFrame:
    """Lengths of the parts of every document with the digests of output and restored text."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )
