"""License scans by patience alignment with license texts.

A text and a template are compared as words (letters and digits, A-Z lower-cased). Words that occur once in both are anchors;
the longest increasing subsequence of their places keeps those that are in the same order, and the gaps between them are
aligned the same way, after what they share at their ends. The share of template words that are aligned is the coverage.

A document may quote a license anywhere and more than once, so that its words are not unique in the whole text. A template is
tried where enough of its distinct words occur in the document at all, around each place of its rarest words, so many of them
that a quote of enough coverage cannot lack all of them: within a
stretch of about the template's length, within the part of it that ends where the word's places of the next quotes are, so that
adjacent quotes are told apart, and just where the quote would be if it were whole. The best of these counts; of found spans of
one template that overlap, those of the best coverage are kept.

Null and empty texts have no spans; templates without words match nothing. Rows are independent; repeated rows get the same
spans each. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import Texts, Words, blocks, joined, lists, span_hashes, struct_array
from haulwatch.llm.decontamination import IS_WORD

#: Share of a template's words that must be aligned, and of the words of the span that must be aligned.
COVERAGE, DENSITY = 0.8, 0.6
#: How many of the template's rarest words are looked for at least.
SEEDS = 3
SPAN = "array<struct<license:string,start:bigint,end:bigint,coverage:double>>"

# The notices and license texts as their publishers word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "rights-reserved": "All rights reserved.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0-text": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
    "GPL-3.0-text": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
}


def increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence: each value goes on the leftmost pile whose top is not smaller."""
    tops, at, below = [], [], [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        below[i] = at[pile - 1] if pile else -1
        tops[pile : pile + 1], at[pile : pile + 1] = [value], [i]
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(i)
        i = below[i]
    return chain[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of aligned words, in order."""
    pairs, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        there, here = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if here[w] == 1 and there.get(w) == 1}
        anchors = [(k, place[w]) for k, w in enumerate(text[a:b], a) if w in place]
        kept = [anchors[i] for i in increasing([k for _, k in anchors])]
        if kept:
            pairs += kept
            edges = [(a - 1, c - 1), *kept, (b, d)]
            todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


class Scanner:
    """Templates as word numbers of a common vocabulary."""

    def __init__(self, templates: dict[str, str]):
        texts = next(blocks(pa.array([*templates.values()], pa.string()), 1 << 62), Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64)))
        words = Words(texts, IS_WORD)
        self.vocabulary, numbers = np.unique(span_hashes(texts.data, words.start, words.end, fold=True), return_inverse=True)
        self.names = [*templates]
        self.templates = [numbers[words.row == k].tolist() for k in range(len(self.names))]
        self.uses = np.zeros((len(self.vocabulary), len(self.names)))
        self.uses[numbers, words.row] = 1

    def spans(self, words: list[int], template: list[int]) -> list[tuple[int, int, float]]:
        """Word spans of a template in the words of a document (-1: in no template), with their coverage."""
        m, n_words = len(template), len(words)
        slack = max(m // 2 + 4, int(m / DENSITY) - m + 1)
        offsets: dict[int, list[int]] = {}
        for k, w in enumerate(template):
            offsets.setdefault(w, []).append(k)
        places: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if w in offsets:
                places.setdefault(w, []).append(k)
        known = [0, *accumulate(w in offsets for w in words)]
        tried: dict[tuple[int, int], tuple[float, int, int, int] | None] = {}

        def quote(lo: int, hi: int) -> tuple[float, int, int, int] | None:
            """Coverage, length (negative), start and end of the quote in a stretch."""
            if known[hi] - known[lo] < COVERAGE * m:
                return None
            if (lo, hi) not in tried:
                pairs = align(words[lo:hi], template)
                tried[lo, hi] = None
                if len(pairs) >= COVERAGE * m:
                    first, past = lo + pairs[0][0], lo + pairs[-1][0] + 1
                    if len(pairs) >= DENSITY * (past - first):
                        tried[lo, hi] = (len(pairs) / m, first - past, first, past)
            return tried[lo, hi]

        found = set()
        whole = bytearray(n_words)  # words of exact quotes
        left, seeds = m, 0  # template words that were not looked for yet
        for w in sorted(offsets, key=lambda w: (len(places.get(w, ())), offsets[w][0])):
            if seeds >= SEEDS and left < COVERAGE * m:
                break
            at, own = places.get(w, []), offsets[w]
            left, seeds = left - len(own), seeds + bool(at)
            for n, k in enumerate(at):
                for j, off in enumerate(own):
                    if whole[k]:
                        break
                    lo, hi = max(0, k - off - slack), min(n_words, k - off + m + slack)
                    before = at[n - j - 1] + 1 if n > j else 0
                    after = at[n - j + len(own)] if n - j + len(own) < len(at) else n_words
                    stretches = ((max(0, k - off), min(n_words, k - off + m)), (max(lo, before), min(hi, after)), (lo, hi))
                    best = max((q for q in (quote(*s) for s in stretches) if q), key=lambda q: q[:2], default=None)
                    if best:
                        found.add(best)
                        if best[:2] == (1, -m):
                            whole[best[2] : best[3]] = b"\1" * m
        taken, kept = bytearray(n_words), []
        for coverage, length, first, past in sorted(found, key=lambda q: (-q[0], -q[1], q[2])):
            if not any(taken[first:past]):
                taken[first:past] = b"\1" * -length
                kept.append((first, past, coverage))
        return sorted(kept)

    def __call__(self, texts: Texts) -> pa.Array:
        """SPAN for each row of a block."""
        words = Words(texts, IS_WORD)
        hashes = span_hashes(texts.data, words.start, words.end, fold=True)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), max(0, len(self.vocabulary) - 1))
        numbers = np.where(self.vocabulary[at] == hashes, at, -1) if len(self.vocabulary) else np.full(len(hashes), -1)
        known = numbers >= 0
        present = np.zeros((len(texts), len(self.vocabulary)), bool)
        present[words.row[known], numbers[known]] = True
        sizes = self.uses.sum(axis=0)
        likely = (present @ self.uses >= COVERAGE * sizes) & (sizes > 0)
        first = np.searchsorted(words.row, np.arange(len(texts) + 1))
        chars = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
        out, counts = [], np.zeros(len(texts), np.int64)
        for row in np.flatnonzero(likely.any(axis=1)).tolist():
            lo, hi, begin = first[row], first[row + 1], texts.bounds[row]
            own = numbers[lo:hi].tolist()
            for k in np.flatnonzero(likely[row]).tolist():
                for a, b, coverage in self.spans(own, self.templates[k]):
                    start, end = words.start[lo + a], words.end[lo + b - 1]
                    out.append((self.names[k], chars[start] - chars[begin], chars[end] - chars[begin], coverage))
                    counts[row] += 1
        columns = [*zip(*out, strict=True)] or [(), (), (), ()]
        kinds = {"license": pa.string(), "start": pa.int64(), "end": pa.int64(), "coverage": pa.float64()}
        values = struct_array({name: pa.array([*map(int, c)] if kind == pa.int64() else c, kind) for (name, kind), c in zip(kinds.items(), columns, strict=True)})
        return lists(values, counts)


def license_spans(text: Column, templates: dict[str, str]) -> Column:
    @F.arrow_udf(SPAN)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
        for batch in batches:
            yield joined([scanner(texts) for texts in blocks(batch)], kind)

    return scan(text)


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, into: str = "licenses") -> DataFrame:
    """The rows with an array column into (replaced if there is one) of spans: license, start, end, coverage."""
    return docs.withColumn(into, license_spans(docs[text], TEMPLATES if templates is None else templates))
