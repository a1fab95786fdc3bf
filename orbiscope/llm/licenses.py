"""License scan by conditional compression.

The words around anchors, over line ends, are aligned with every line of every
template.  A stretch of words is a notice when at most ``MAX_DIFFERENCE`` of the
template line's words are missing from it or added to it; the differences are
reported.  Where notices overlap, the one with the most words that agree, less
those that differ, stays; equal ones are told apart by compressing the stretch
with zstandard, once on its own and once with each template as a raw dictionary:
the template that shrinks it most wins.  The words between notices are searched
again until nothing more is found.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import slices

# Notice wordings by license.  The first line of each is its short form.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED"
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see"
        " <https://www.gnu.org/licenses/>.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Proprietary": ("All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
}
#: Words near one of these are candidates.  A given template line without one brings anchors of its own.
ANCHOR = re.compile(
    rb"licen[sc]|rights\W+reserved|copyright|\bcc\W*(?:by|0)|public\W+domain|permission|redistribut|warrant|proprietary", re.I
)
#: Share of the words that may differ from the template's wording.
MAX_DIFFERENCE = 0.34
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Notice:
    license: str
    start: int  # bytes of the UTF-8 text
    end: int
    reduction: float
    missing: tuple[str, ...]  # words of the template line that the notice lacks
    added: tuple[str, ...]  # words of the notice that the template lacks


@dataclass
class Templates:
    """Compressors with each template as raw dictionary."""

    templates: dict[str, tuple[str, ...]]
    level: int = 3
    _ready: dict = field(default_factory=dict)
    lines: list[tuple[str, list[str]]] = field(init=False)  # (license, words) of every template line
    reach: int = field(init=False)  # words of the longest stretch that can be a notice

    def __post_init__(self):
        split = [(n, [m[0].lower() for m in WORD.finditer(line)]) for n, lines in self.templates.items() for line in lines]
        self.lines = [(n, words) for n, words in split if words]
        self.reach = int(max((len(w) for _, w in self.lines), default=0) * (1 + MAX_DIFFERENCE)) + 1
        self._counts = [Counter(w) for _, w in self.lines]
        self.anchor = ANCHOR
        if own := {w.encode() for name, lines in self.templates.items() for line in lines for w in own_anchors(line)}:
            words = rb"|".join(rb"(?<!\w)" + re.escape(w) + rb"(?!\w)" for w in sorted(own))
            self.anchor = re.compile(ANCHOR.pattern + rb"|" + words, re.I)

    def compressors(self):
        if not self._ready:
            import zstandard

            def options(data: bytes):
                params = zstandard.ZstdCompressionParameters.from_level(
                    self.level, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
                )
                if not data:
                    return zstandard.ZstdCompressor(compression_params=params)
                return zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                    compression_params=params,
                )

            self._ready[""] = options(b"")
            for name, lines in self.templates.items():
                self._ready[name] = options("\n".join(lines).lower().encode())
        return self._ready

    def reductions(self, stretch: bytes) -> dict[str, float]:
        """The share of the stretch's compressed size that each template saves."""
        data = stretch.lower()
        ready = self.compressors()
        alone = len(ready[""].compress(data))
        return {n: 1 - len(ready[n].compress(data)) / alone for n in self.templates}

    def stretches(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(line, start, end) of the stretches of ``words`` that are worded like a template line.

        An alignment scores 1 for a word in common and -1 for an added one, so a
        line of m words differs from a stretch by m less their score.  The scores
        of all lines are carried along the words at once; a stretch is taken
        where a line's score is highest before it falls by more than it may.
        """
        have = Counter(words)
        lines = [
            i
            for i, (_, want) in enumerate(self.lines)
            if sum(min(n, have[w]) for w, n in self._counts[i].items()) >= (1 - MAX_DIFFERENCE) * len(want)
        ]
        if not lines:
            return
        ids = {w: k for k, w in enumerate({w for i in lines for w in self._counts[i]})}
        size = max(len(self.lines[i][1]) for i in lines)
        want = np.full((len(lines), size), -2)
        for k, i in enumerate(lines):
            want[k, : len(self.lines[i][1])] = [ids[w] for w in self.lines[i][1]]
        least = np.array([np.ceil((1 - MAX_DIFFERENCE) * len(self.lines[i][1]) - 1e-9) for i in lines])
        same = {w: want == k for w, k in ids.items()}
        nowhere = np.zeros_like(want, bool)
        # score and start in one number: of equal scores the earlier start
        one = 1 << 40
        best = np.full((len(lines), size + 1), one - 1)
        held: list[tuple[int, int, int] | None] = [None] * len(lines)  # (score, start, end) of the stretch that is open
        for j, w in enumerate(words):
            after = best - one
            np.maximum(after[:, 1:], np.where(same.get(w, nowhere), best[:, :-1] + one, 0), out=after[:, 1:])
            np.maximum(after, one - 2 - j, out=after)
            best = np.maximum.accumulate(after, axis=1)
            last = best[:, -1]
            for k in np.flatnonzero(last >> 40 >= least):
                score, start = int(last[k]) >> 40, one - 1 - (int(last[k]) & (one - 1))
                if held[k] is not None and start >= held[k][2]:  # begins after the open one
                    yield lines[k], *held[k][1:]
                    held[k] = None
                if held[k] is None or score > held[k][0] or (score, start) == held[k][:2]:
                    held[k] = score, start, j + 1
        for k, stretch in enumerate(held):
            if stretch is not None:
                yield lines[k], *stretch[1:]

    def wording(self, line: int, words: list[str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """(missing, added) words of an alignment of a template line with ``words`` that has the most in common."""
        want = self.lines[line][1]
        common = [[0] * (len(words) + 1) for _ in range(len(want) + 1)]
        for a in range(len(want) - 1, -1, -1):
            for b in range(len(words) - 1, -1, -1):
                common[a][b] = (
                    common[a + 1][b + 1] + 1 if want[a] == words[b] else max(common[a + 1][b], common[a][b + 1])
                )
        a = b = 0
        missing, added = [], []
        while a < len(want) or b < len(words):
            if a < len(want) and b < len(words) and want[a] == words[b]:
                a, b = a + 1, b + 1
            elif b == len(words) or a < len(want) and common[a + 1][b] >= common[a][b + 1]:
                missing.append(want[a])
                a += 1
            else:
                added.append(words[b])
                b += 1
        return tuple(missing), tuple(added)

    def scan(self, text: bytes | None) -> list[Notice]:
        """The notices of a text, in order of their start, without overlaps."""
        if not text or self.anchor.search(text) is None:
            return []
        out: list[Notice] = []
        for start, end in candidate_blocks(text, self.reach, self.anchor):
            block = text[start:end].decode("utf-8", "replace")
            found = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(block)]
            words = [w for w, _, _ in found]
            code = np.frombuffer(block.encode("utf-32-le"), "<u4")
            byte = np.r_[0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))]  # of every character
            gaps = [(0, len(words))]
            while gaps:
                a, b = gaps.pop()
                confirmed = []
                for line, i, j in self.stretches(words[a:b]):
                    missing, added = self.wording(line, words[a + i : a + j])
                    differ = len(missing) + len(added)
                    share = differ / len(self.lines[line][1])
                    if share <= MAX_DIFFERENCE:
                        agree = len(self.lines[line][1]) - len(missing)
                        confirmed.append((differ - agree, share, a + i, a + j, line, missing, added))
                taken: list[tuple[int, int]] = []
                saved: dict[tuple[int, int], dict[str, float]] = {}

                def reduction(i: int, j: int, name: str) -> float:
                    if (i, j) not in saved:
                        saved[i, j] = self.reductions(block[found[i][1] : found[j - 1][2]].encode())
                    return saved[i, j][name]

                ordered = [(c[0], c[1], -reduction(c[2], c[3], self.lines[c[4]][0]), self.lines[c[4]][0], *c[2:]) for c in confirmed]
                for _, _, less, name, i, j, _, missing, added in sorted(ordered):
                    if all(j <= x or y <= i for x, y in taken):
                        taken.append((i, j))
                        first, past = start + int(byte[found[i][1]]), start + int(byte[found[j - 1][2]])
                        out.append(Notice(name, first, past, round(-less, 6), missing, added))
                if taken:
                    edges = [a, *(x for span in sorted(taken) for x in span), b]
                    gaps += [(x, y) for x, y in zip(edges[::2], edges[1::2], strict=True) if x < y]
        return sorted(out, key=lambda n: n.start)


def own_anchors(line: str) -> list[str]:
    """Words of a template line without an anchor, its longest ones, one of which each of its notices must have."""
    words = sorted((m[0] for m in WORD.finditer(line)), key=lambda w: (-len(w), w))
    if ANCHOR.search(line.encode()) or not words:
        return []
    return words[: int(MAX_DIFFERENCE * len(words)) + 1]


def candidate_blocks(text: bytes, reach: int, anchor: re.Pattern[bytes] = ANCHOR) -> Iterator[tuple[int, int]]:
    """Byte ranges of the words at most ``reach`` words away from an anchor; ranges that meet are one."""
    anchors = [m.start() for m in anchor.finditer(text)]
    bounds = [0, *(m.end() for m in re.finditer(rb"\W+", text)), len(text)]
    spans: list[list[int]] = []
    for a in anchors:
        at = bisect_right(bounds, a) - 1
        first, past = max(0, at - reach), min(len(bounds) - 1, at + reach + 1)
        if spans and first <= spans[-1][1]:
            spans[-1][1] = past
        else:
            spans.append([first, past])
    for first, past in spans:
        yield bounds[first], bounds[past]


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """(id_col, notices) for every row; map-side only.

    A notice is (license, start, end, reduction, missing, added): the byte range
    of its wording, the share of its compressed size that the template saved, and
    the differing words.  Null and empty texts have none.  Every notice is
    reported, also several in a line, and line ends may fall anywhere in one.  Of
    overlapping notices the one with the most words that agree, less those that
    differ, stays, then the larger reduction, then the license that sorts first.
    """
    kind = pa.list_(
        pa.struct(
            [
                ("license", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("reduction", pa.float64()),
                ("missing", pa.list_(pa.string())),
                ("added", pa.list_(pa.string())),
            ]
        )
    )
    wanted = templates or TEMPLATES

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Templates(wanted)
        for batch in batches:
            for part in slices(batch, 1):
                found = [
                    [
                        {"license": n.license, "start": n.start, "end": n.end, "reduction": n.reduction,
                         "missing": list(n.missing), "added": list(n.added)}
                        for n in scanner.scan(t)
                    ]
                    for t in part.column(1).cast(pa.binary()).to_pylist()
                ]
                yield pa.record_batch([part.column(0), pa.array(found, kind)], names=["key", "notices"])

    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    key = keyed.schema["key"].dataType.simpleString()
    notice = "license:string,start:long,end:long,reduction:double,missing:array<string>,added:array<string>"
    return keyed.mapInArrow(kernel, f"key {key}, notices array<struct<{notice}>>").withColumnRenamed("key", id_col)


def scan_query(docs: DataFrame) -> DataFrame:
    """doc_id, number of notices, their licenses (sorted, once each), their ranges, and the words that differ."""
    found = scan_licenses(docs)
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["license"]))), ",").alias("licenses"),
        F.array_join(
            F.transform("notices", lambda n: F.concat_ws(":", n["license"], n["start"], n["end"])), ","
        ).alias("spans"),
        F.coalesce(
            F.aggregate("notices", F.lit(0), lambda a, n: a + F.size(n["missing"]) + F.size(n["added"])), F.lit(0)
        ).alias("n_differences"),
    )
