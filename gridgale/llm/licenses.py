"""License scans: lines, paragraphs and windows against license templates, by word bigrams.

A text part and a template are as alike as the Dice coefficient of their sets of word
bigrams says. The sizes of two sets bound it, so most templates are never counted for a part.
Windows have the length of a template and begin wherever the text has one of its bigrams,
so a notice is found inside a longer line, over lines and over paragraphs.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.75
MORE = 4
WORDS = re.compile(r"[a-z0-9]+")
PARAGRAPHS = re.compile(r"\n[ \t\r]*\n")
LINES = re.compile("\n")

# Names of licenses, the wordings of notices, and longer texts of licenses.
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "ISC": ["ISC License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication"],
}
WORDINGS = [
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.",
    "This work is licensed under a {}.", "Distributed under the terms of the {}.",
]
NOTICES = [("All-Rights-Reserved", "All rights reserved.")]
# Windows only: copyright notices differ in their names, but not in how they begin.
COPYRIGHTS = [("Copyright", t) for t in ("Copyright (c)", *(f"Copyright {year}" for year in range(1960, 2060)))]
BSD = "BSD-2-Clause OR BSD-3-Clause"  # what both begin with
BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""
BSD_THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
LONGER = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    (BSD, """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:"""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
option) any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version."""),
    ("LGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
your option) any later version."""),
    ("BSD-3-Clause", BSD_THIRD),
    ("BSD-2-Clause", f"{BSD_CLAUSES}\n{BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{BSD_CLAUSES} 3. {BSD_THIRD}\n{BSD_DISCLAIMER}"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    # The titles of the long licenses, as their full texts begin.
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]


def templates() -> list[tuple[str, str]]:
    """(license, text) of all templates, without those whose words another one has already."""
    out, seen = [], set()
    notices = [(k, w.format(n)) for k, names in NAMES.items() for n in names for w in WORDINGS]
    for name, text in [*notices, *LONGER, *NOTICES]:
        if (words := tuple(normalised(text))) not in seen:
            seen.add(words)
            out.append((name, text))
    return out


def normalised(text: str) -> list[str]:
    """The words in lower case, without punctuation."""
    return WORDS.findall(text.lower())


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def places(text: str) -> list[tuple[int, int]]:
    """Where the words of `normalised` stand in the text; lower case may be longer than the text."""
    lower = text.lower()
    at = range(len(text)) if len(lower) == len(text) else [i for i, c in enumerate(text) for _ in c.lower()]
    return [(at[m.start()], at[m.end() - 1] + 1) for m in WORDS.finditer(lower)]


class Scanner:
    def __init__(self, known: list[tuple[str, str]], least: float, windows_only: list[tuple[str, str]]):
        every = [*known, *windows_only]
        self.names, self.least, self.n_known = [k for k, _ in every], least, len(known)
        worded = [normalised(t) for _, t in every]
        sets = [bigrams(w) for w in worded]
        self.sizes, self.lengths = [len(s) for s in sets], [len(w) - 1 for w in worded]
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, s in enumerate(sets):
            for b in s:
                self.holders.setdefault(b, []).append(i)

    def best(self, words: list[str]) -> tuple[str, float, int] | None:
        """The template most alike, the first of equals, with its shared bigrams; nothing under the limit."""
        own = bigrams(words)
        low, high = len(own) * self.least / (2 - self.least), len(own) * (2 - self.least) / self.least
        shared: Counter[int] = Counter()
        for b in own:
            for i in self.holders.get(b, ()):
                if i < self.n_known and low <= self.sizes[i] <= high:
                    shared[i] += 1
        found = [(2 * n / (len(own) + self.sizes[i]), -i) for i, n in shared.items()]
        score, i = max(found, default=(0.0, 0))
        return (self.names[-i], score, shared[-i]) if score >= self.least else None

    def windows(self, pairs: list[tuple[str, str]]) -> list[tuple[int, float, int, int, int]]:
        """(shared, score, template, first, last) of windows as long as a template that begin with a bigram of
        it, places as word numbers; of windows that meet, the one with the most shared bigrams."""
        held = defaultdict(list)
        for p, b in enumerate(pairs):
            for i in self.holders.get(b, ()):
                held[i].append(p)
        found = []
        for i, at in held.items():
            size, need = self.sizes[i], self.least * self.sizes[i] / (2 - self.least)
            if len(at) < need:
                continue
            inside: Counter[tuple[str, str]] = Counter()
            end = 0
            for p in at:
                while end < len(at) and at[end] < p + self.lengths[i]:
                    inside[pairs[at[end]]] += 1
                    end += 1
                shared = len(inside)
                if shared >= need:
                    score = 2 * shared / (len(set(pairs[p : p + self.lengths[i]])) + size)
                    if score >= self.least:
                        found.append((shared, score, i, p, min(p + self.lengths[i], len(pairs))))
                if inside[pairs[p]] == 1:
                    del inside[pairs[p]]
                else:
                    inside[pairs[p]] -= 1
        found.sort(key=lambda w: (-w[0], -w[1], w[2], w[3]))
        taken, kept = bytearray(len(pairs) + 1), []
        for w in found:
            if 1 not in taken[w[3] : w[4] + 1]:
                taken[w[3] : w[4] + 1] = b"\1" * (w[4] + 1 - w[3])
                kept.append(w)
        return kept

    def matches(self, text: str) -> list[dict]:
        """Lines, and paragraphs of several lines, with the license they state, and windows elsewhere.

        A window that meets lines or paragraphs with a license counts where it shares MORE
        bigrams more than each of them, and takes the place of those inside it; with less it may
        be one of them and a word from the line before.
        """
        words = normalised(text)
        pairs = list(zip(words, words[1:]))
        if self.holders.keys().isdisjoint(pairs):
            return []
        out = []
        for begin, body in _split(text, PARAGRAPHS):
            lines = [(begin + m, line) for m, line in _split(body, LINES)]
            worded = [(a, line, normalised(line)) for a, line in lines]
            units = [("line", a, a + len(line), words) for a, line, words in worded]
            if len(lines) > 1:
                units.append(("paragraph", begin, begin + len(body), [w for _, _, words in worded for w in words]))
            for kind, a, b, words in units:
                if hit := self.best(words):
                    out.append(({"unit": kind, "start": a, "end": b, "license": hit[0], "score": hit[1]}, hit[2]))
        if windows := self.windows(pairs):
            spans = places(text)
            for shared, score, i, first, last in sorted(windows, key=lambda w: w[3]):
                a, b = spans[first][0], spans[last][1]
                if all(n + MORE <= shared for m, n in out if m["start"] < b and a < m["end"]):
                    out = [(m, n) for m, n in out if not _inside(m, spans, first, last)]
                    out.append(({"unit": "window", "start": a, "end": b, "license": self.names[i], "score": score}, shared))
        return [m for m, _ in out]


def _inside(match: dict, spans: list[tuple[int, int]], first: int, last: int) -> bool:
    """Whether all words of the match are words of the window."""
    return bisect_left(spans, (match["start"], 0)) >= first and bisect_left(spans, (match["end"], 0)) <= last + 1


def _split(text: str, at: re.Pattern) -> Iterator[tuple[int, str]]:
    begin = 0
    for m in at.finditer(text):
        yield begin, text[begin : m.start()]
        begin = m.end()
    yield begin, text[begin:]


def scan_licenses(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text",
    known: list[tuple[str, str]] | None = None, least: float = LEAST,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `matches`, an array of (`unit`, `start`, `end`,
    `license`, `score`): the lines and paragraphs that state a license, and the windows of a template's
    length that do so inside longer ones or across them; places in code points.

    A null or empty text has no matches, and neither has a part of fewer than two words.
    Repeated rows are scanned each; of templates equally alike the first counts. An
    empty table stays empty. Texts are read once and nothing is shuffled.
    """
    scanner = Scanner(known or templates(), least, [] if known else COPYRIGHTS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([
            ("unit", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("score", pa.float64()),
        ]))
        for batch in batches:
            found = [scanner.matches(t.as_py() or "") for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(found, kind)], names=["row", "matches"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"row {kind}, matches array<struct<unit:string,start:bigint,end:bigint,license:string,score:double>>"
    )
