"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

Texts and templates are lower-cased words (letters and digits) in shingles of five.  Windows of a text
overlap so that every stretch of a template's length lies whole in one of them; a window is little
longer than the templates it is for, so a window that holds at least ``LEAST`` of a template's shingles
resembles it by 0.5 or more (templates of up to 16 shingles: by 1/4 or more).  With 24 bands of two rows
such a window collides with the template with probability over 0.998; the short templates use 48 bands
of one row (over 0.999998).  Retrieved templates are verified by the share of their distinct shingles that
the window, widened by a quarter on each side, holds.

Work is done row by row inside each task; the templates are a small list that goes along with the code
(its bands are checked against ``MOST_BANDS``).  Texts are scanned whole, a stretch at a time.

Edge cases: null and empty texts have no matches; repeated templates in one text are one match each
unless their windows touch, in which case they are one; ties go to the earliest place.  Templates of
fewer than five words are refused.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.llm.pieces import runs

WORDS, LEAST, HASHES = 5, 0.8, 48
SHORT, STRIDE = 16, 4
MOST_BANDS = 2_000_000
_STRETCH = 16_384  # shingles whose minima are held at once
_WORD = re.compile(r"[^\W_]+")
_MATCH = "array<struct<license:string,from_word:int,to_word:int,containment:double>>"

# Notices of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "CC-BY-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of "
        "this license, visit http://creativecommons.org/licenses/by/4.0/",
    ),
    (
        "MIT",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a "
        "copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    ),
)


_known: dict[str, int] = {}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles_of(words: list[str]) -> np.ndarray:
    """A 64-bit hash for each shingle of five words, in order."""
    if len(words) < WORDS:
        return np.empty(0, np.uint64)
    known = _known
    if len(known) > 500_000:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh64_intdigest(word.encode())
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    out = own[:n].copy()
    for k in range(1, WORDS):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += own[k : n + k]
    return out


_RNG = np.random.RandomState(23)
_SCALE = (_RNG.randint(1, 2**31, HASHES).astype(np.uint64) << np.uint64(32)) | np.uint64(1)
_SCALE |= _RNG.randint(0, 2**31, HASHES).astype(np.uint64) << np.uint64(1)


def _hashed(shingles: np.ndarray) -> np.ndarray:
    """HASHES 32-bit hashes of each shingle, one row per hash."""
    return ((shingles[None, :] * _SCALE[:, None]) >> np.uint64(32)).astype(np.uint32)


def _mixed(minima: np.ndarray, rows: int) -> np.ndarray:
    """Band keys of windows from their minima (one row per hash)."""
    if rows == 1:
        return minima
    a, b = minima[0::2].astype(np.uint64), minima[1::2].astype(np.uint64)
    return (((a << np.uint64(32)) | b) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


class Scale:
    """The templates whose windows have one length."""

    def __init__(self, stride: int, blocks: int, rows: int):
        self.stride, self.blocks, self.rows = stride, blocks, rows
        bands = HASHES // rows
        self.maybe = np.zeros((bands, 65536), bool)
        self.table: dict[tuple[int, int], list[int]] = {}

    def add(self, number: int, keys: np.ndarray) -> None:
        for band, key in enumerate(keys[:, 0].tolist()):
            self.maybe[band, key >> 16] = True
            self.table.setdefault((band, key), []).append(number)

    def find(self, minima: np.ndarray) -> set[tuple[int, int]]:
        """Pairs (window, template) that share a band; ``minima`` are of the scale's windows."""
        keys, out = _mixed(minima, self.rows), set()
        for band in range(len(keys)):
            for at in np.flatnonzero(self.maybe[band][keys[band] >> 16]).tolist():
                for number in self.table.get((band, int(keys[band, at])), ()):
                    out.add((at, number))
        return out


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in templates]
        self.shingles, self.scales = [], {}
        for number, (name, text) in enumerate(templates):
            own = np.unique(shingles_of(words_of(text)))
            if not len(own):
                raise ValueError(f"the template of {name} has fewer than {WORDS} words")
            self.shingles.append(own)
            size = len(words_of(text)) - WORDS + 1
            stride = STRIDE
            while stride * 8 <= size:
                stride *= 2
            blocks = -(-(size - 1) // stride) + 1  # a stretch of ``size`` lies whole in one window
            rows = 1 if size <= SHORT else 2
            scale = self.scales.setdefault((stride, blocks, rows), Scale(stride, blocks, rows))
            scale.add(number, _mixed(_hashed(own).min(axis=1, keepdims=True), rows))
        if sum(len(s.table) for s in self.scales.values()) > MOST_BANDS:
            raise ValueError("too many templates to send with the code")
        self.widest = max(s.stride * s.blocks for s in self.scales.values())
        self.coarsest = max(s.stride for s in self.scales.values())

    def scan(self, texts: list[str]) -> list[list[dict]]:
        """Matches of each text.  Texts stand end to end; a window over a border is verified in each."""
        each = [shingles_of(words_of(t)) for t in texts]
        ends = np.cumsum([len(e) for e in each])
        shingles = np.concatenate(each) if each else np.empty(0, np.uint64)
        found: list[dict[int, list]] = [{} for _ in texts]
        step = _STRETCH - _STRETCH % self.coarsest
        for begin in range(0, len(shingles), step):
            blocks = self._blocks(shingles[begin : begin + step + self.widest])
            for scale in self.scales.values():
                for window, number in scale.find(self._windows(blocks[scale.stride], scale.blocks)):
                    low = begin + window * scale.stride
                    high = min(low + scale.stride * scale.blocks, len(shingles))
                    for k in range(*np.searchsorted(ends, [low, high - 1], side="right") + [0, 1]):
                        hit = self._verify(each[k], number, low - (ends[k] - len(each[k])), scale)
                        if hit:
                            found[k].setdefault(number, []).append(hit)
        return [self._merged(f) for f in found]

    def _blocks(self, part: np.ndarray) -> dict[int, np.ndarray]:
        """Minima over consecutive stretches of 4, 8, ... shingles."""
        now = np.minimum.reduceat(_hashed(part), np.arange(0, len(part), STRIDE), axis=1)
        out, stride = {STRIDE: now}, STRIDE
        while stride < self.coarsest:
            now, stride = np.minimum.reduceat(now, np.arange(0, now.shape[1], 2), axis=1), 2 * stride
            out[stride] = now
        return out

    @staticmethod
    def _windows(fine: np.ndarray, blocks: int) -> np.ndarray:
        """Minima over ``blocks`` consecutive blocks from each one on (fewer at the end)."""
        wide, have = fine.copy(), 1
        while have < blocks:
            more = min(have, blocks - have)
            reach = max(0, wide.shape[1] - more)
            wide[:, :reach] = np.minimum(wide[:, :reach], wide[:, more:])
            have += more
        return wide

    def _verify(self, shingles: np.ndarray, number: int, low: int, scale: Scale) -> tuple[int, int, float] | None:
        own, size = self.shingles[number], scale.stride * scale.blocks
        high = min(len(shingles), low + size + size // 4)
        low = max(0, low - size // 4)
        at = np.searchsorted(own, shingles[low:high])
        at[at == len(own)] = 0
        same = own[at] == shingles[low:high]
        share = len(np.unique(at[same])) / len(own)
        if share < LEAST:
            return None
        places = np.flatnonzero(same)
        return low + int(places[0]), low + int(places[-1]) + WORDS, share

    def _merged(self, found: dict[int, list[tuple[int, int, float]]]) -> list[dict]:
        out = []
        for number, hits in found.items():
            merged: list[list] = []
            for low, high, share in sorted(hits):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                    merged[-1][2] = max(merged[-1][2], share)
                else:
                    merged.append([low, high, share])
            out += [
                {"license": self.names[number], "from_word": a, "to_word": b, "containment": s} for a, b, s in merged
            ]
        return sorted(out, key=lambda m: (m["from_word"], m["to_word"], m["license"]))


@lru_cache(maxsize=4)
def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    """One scanner per Python worker."""
    return Scanner(templates)


def scan(text: Column | str, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Column:
    """Column of matches: license, words [``from_word``, ``to_word``), containment; in order of place."""
    scanner(templates)  # refuse bad templates here, not in a task

    @F.arrow_udf(_MATCH)
    def matches(texts: pa.Array) -> pa.Array:
        own = scanner(templates)
        kind = pa.struct(
            [("license", pa.string()), ("from_word", pa.int32()), ("to_word", pa.int32()), ("containment", pa.float64())]
        )
        found = [m for run in runs([t.as_py() or "" for t in texts], 1_000_000) for m in own.scan(run)]
        return pa.array(found, pa.list_(kind))

    return matches(text)
