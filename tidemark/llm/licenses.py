"""License scans by conditional compression.

Lines of a text that carry a word of licensing, and the lines next to them as
far as a template reaches, are candidate blocks; a line without words ends a
block, as templates are single paragraphs. A block is compressed alone and with
each template as a raw zstandard dictionary: the more of a template it repeats,
the more bytes the dictionary saves. In order of these savings the templates are
confirmed by wording: a template is aligned with the block at the lowest cost,
the words that must be inserted or deleted to turn it into a passage of the
block, of which a small share is allowed. Savings count by the share of words confirmed,
and the passage that counts most is taken before those it overlaps.
Every template that the block has enough words for is tried, none is cut off by
its rank. Words with digits, such as versions, must be there as they are. Years,
names and places in a template stand as slots; the words around a slot must be
there, too.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import prepare

#: Words of a line that make it a candidate; a line without any of them is not a license line.
CUES = r"(?i)licen[sc]|copyright|copyleft|\(c\)\s*\d|©|permission|warrant|redistribut|public domain|all rights reserved|spdx"
#: Words a slot stands for at most.
SLOT = 6
#: Share of words that may differ.
DIFFERENT = 0.2
#: Words that are aligned at a time; a longer block goes in windows that overlap by the longest match.
WINDOW = 1024
#: Compression level.
LEVEL = 3

# Wordings of common licenses and notices; {} stands for a name, year or place.
WORDINGS: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at {}"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {}"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright {} {}. All rights reserved."),
    ("BSD-4-Clause", "Released under the BSD 4-Clause License."),
    ("ISC", "Licensed under the ISC License."),
)

#: The wordings and a tag line for every license of a name of its own.
TEMPLATES = WORDINGS + tuple(
    (name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(n for n, _ in WORDINGS) if name not in ("BSD", "proprietary")
)

_CUE = regex.compile(CUES)
_WORD = regex.compile(r"\{\}|[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*")


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Scanner:
    """Templates with their compressors and words."""

    def __init__(self, templates=TEMPLATES):
        self.templates = templates
        self.words = [wording(t) for _, t in templates]
        # A slot is a row of steps that each take any word, or none, at no cost.
        self.steps = [[x for w in ws for x in ([w] * SLOT if w == "{}" else [w])] for ws in self.words]
        self.bags = [Counter(w for w in ws if w != "{}") for ws in self.words]
        # Words that may not be missing: those with digits, and those next to a slot, which say where it begins and ends.
        self.needed = [
            {w for w in ws if _has_digit(w)} | {w for pair in zip(ws, ws[1:]) if "{}" in pair for w in pair if w != "{}"} for ws in self.words
        ]
        self.allowed = [int(DIFFERENT * len(ws) + 1e-9) for ws in self.words]
        self.reach = max((len(st) + cost for st, cost in zip(self.steps, self.allowed)), default=0)
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(self.plain(t).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, t in templates
        ]

    @staticmethod
    def plain(text: str) -> str:
        return " ".join(text.lower().split())

    def savings(self, block: str) -> list[float]:
        """Share of the compressed block that each template as a dictionary saves."""
        data = self.plain(block).encode()
        size = len(self.alone.compress(data))
        return [(size - len(g.compress(data))) / size for g in self.given]

    def align(self, i: int, block: list[str]) -> tuple[int, int, list[str], list[str]] | None:
        """Words of the block that the template matches best (from, to), and words missing and added; None beyond the allowed cost."""
        steps, n = self.steps[i], len(block)
        numbers = {w: k for k, w in enumerate(dict.fromkeys(steps))}
        ids = np.fromiter((numbers.get(w, -1) for w in block), np.int64, n)
        along = np.arange(n + 1)
        cost = np.zeros((len(steps) + 1, n + 1), np.int64)
        for k, w in enumerate(steps):
            row = cost[k] + (w != "{}")
            met = np.ones(n, bool) if w == "{}" else ids == numbers[w]
            row[1:] = np.where(met, np.minimum(row[1:], cost[k, :-1]), row[1:])
            cost[k + 1] = np.minimum.accumulate(row - along) + along
        end = at = int(cost[-1].argmin())
        if cost[-1, end] > self.allowed[i]:
            return None
        k, missing, added = len(steps), [], []
        while k:
            w, c = steps[k - 1], cost[k, at]
            if at and (w == "{}" or w == block[at - 1]) and c == cost[k - 1, at - 1]:
                k, at = k - 1, at - 1
            elif c == cost[k - 1, at] + (w != "{}"):
                missing += [w] if w != "{}" else []
                k -= 1
            else:
                added.append(block[at - 1])
                at -= 1
        return at, end, missing[::-1], added[::-1]

    def matches(self, i: int, block: list[str], low: int, high: int) -> list[tuple[int, int, list[str], list[str]]]:
        """Passages of ``block[low:high]`` that a template matches, none of which overlap."""
        longest = len(self.steps[i]) + self.allowed[i]
        if high - low <= WINDOW + longest:
            return self._matches(i, block, low, high)
        found = []
        for at in range(low, high, WINDOW):
            found += self._matches(i, block, at, min(at + WINDOW + longest, high))
        # Windows share their edges: of passages found twice or in part the better one stays.
        kept, taken = [], np.zeros(high - low, bool)
        for m in sorted(found, key=lambda m: (len(m[2]) + len(m[3]), m[0] - m[1], m[0])):
            part = taken[m[0] - low : m[1] - low]
            if not part.any():
                part[:] = True
                kept.append(m)
        return kept

    def _matches(self, i: int, block: list[str], low: int, high: int) -> list[tuple[int, int, list[str], list[str]]]:
        found, todo = [], [(low, high)]
        while todo:
            low, high = todo.pop()
            # A match lacks at most the allowed number of words, so fewer in the whole part rule the template out;
            # so does a needed word that is not there at all.
            held = Counter(w for w in block[low:high] if w in self.bags[i])
            lacking = self.bags[i] - held
            if sum(lacking.values()) > self.allowed[i] or not self.needed[i].isdisjoint(lacking):
                continue
            best = self.align(i, block[low:high])
            if best and best[1] > best[0]:
                begin, end = low + best[0], low + best[1]
                if self.needed[i].isdisjoint(best[2]):
                    found.append((begin, end, *best[2:]))
                todo += [(low, begin), (end, high)]
        return found

    def blocks(self, lines: list[list[str]], cued: list[bool]) -> list[tuple[list[str], list[int], list[tuple[int, int]]]]:
        """Words of each run of adjacent lines with words, the line of each word, and the parts within reach of a cue."""
        out, first = [], 0
        while first < len(lines):
            last = first
            while last < len(lines) and lines[last]:
                last += 1
            if any(cued[first:last]):
                block = [w for ws in lines[first:last] for w in ws]
                at = [n for n in range(first, last) for _ in lines[n]]
                parts: list[tuple[int, int]] = []
                place = 0
                for n in range(first, last):
                    if cued[n]:
                        low, high = max(0, place - self.reach), min(len(block), place + len(lines[n]) + self.reach)
                        if parts and low <= parts[-1][1]:
                            low = parts.pop()[0]
                        parts.append((low, high))
                    place += len(lines[n])
                out.append((block, at, parts))
            first = last + 1
        return out

    def scan(self, text: str) -> list[dict]:
        """License passages of a text: place of their lines, license, how much the template saves and how the wording differs."""
        rows = text.split("\n")
        cued = [bool(_CUE.search(r)) for r in rows]
        if not any(cued):
            return []
        starts = np.cumsum([0, *(len(r) + 1 for r in rows)]).tolist()
        found = []
        for block, at, parts in self.blocks([wording(r) for r in rows], cued):
            tried = []
            for low, high in parts:
                saved = self.savings("\n".join(rows[at[low] : at[high - 1] + 1]))
                for i in sorted(range(len(self.templates)), key=lambda i: (-saved[i], i)):
                    for begin, end, missing, added in self.matches(i, block, low, high):
                        if any(cued[at[begin] : at[end - 1] + 1]):
                            # Close savings are settled by the share of the wording that is confirmed.
                            share = (len(missing) + len(added)) / max(len(self.words[i]), 1)
                            tried.append((saved[i] * (1 - share), saved[i], i, begin, end, missing, added))
            taken = np.zeros(len(block), bool)
            for _, saving, i, begin, end, missing, added in sorted(tried, key=lambda t: -t[0]):
                if taken[begin:end].any():
                    continue
                taken[begin:end] = True
                first, last = at[begin], at[end - 1]
                found.append(
                    (first, begin, {
                        "line": first,
                        "start": starts[first],
                        "length": starts[last + 1] - 1 - starts[first],
                        "license": self.templates[i][0],
                        "template": i,
                        "saving": float(saving),
                        "n_missing": len(missing),
                        "n_added": len(added),
                        "missing": " ".join(missing),
                        "added": " ".join(added),
                        "matched": " ".join(block[begin:end]),
                    })
                )
        return [row for *_, row in sorted(found, key=lambda f: f[:2])]


def _has_digit(word: str) -> bool:
    return any(c.isdigit() for c in word)


_SPAN = (
    "array<struct<line:int,start:long,length:long,license:string,template:int,saving:double,n_missing:int,n_added:int,"
    "missing:string,added:string,matched:string>>"
)


def license_lines(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per license passage of ``docs``: ``doc_id``, ``line`` (the first), ``start`` and ``length`` of its whole lines in
    code points, ``license``, ``template``, ``saving``, ``n_missing``, ``n_added``, ``missing``, ``added``, ``matched``.

    Every line with a licensing word is tried together with the lines around
    it, whatever the length of the text; several passages of a line each give a
    row. A passage whose wording differs from every template in more than a
    fifth of its words, or lacks one with a digit or next to a slot, gives none. Of
    overlapping passages the one whose template saves the block more is named,
    savings less the share of words that differ, of equal ones the first listed. Null and empty texts give none, and so
    does an empty table. Repeated rows each give their passages; other columns
    are ignored.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf(_SPAN)
    def scan(texts: pa.Array) -> pa.Array:
        scanner = Scanner(templates)
        types = [
            ("line", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("license", pa.string()),
            ("template", pa.int32()), ("saving", pa.float64()), ("n_missing", pa.int32()), ("n_added", pa.int32()),
            ("missing", pa.string()), ("added", pa.string()), ("matched", pa.string()),
        ]
        return pa.array([scanner.scan(t) for t in texts.to_pylist()], pa.list_(pa.struct(types)))

    # Texts without any licensing word do not leave the scan.
    likely = docs.select("doc_id", "text").filter(F.col("text").rlike(CUES))
    return likely.select("doc_id", F.explode(scan("text")).alias("s")).select("doc_id", "s.*")
