"""License scans by patience alignment (operator 6).

A license template and a text are aligned like two versions of a file.
Words that occur once in both are anchors; their longest run in the same
order (longest increasing subsequence) is fixed, and the gaps between
anchors are aligned the same way, after equal words at their ends are
matched off.  The part of the template's words that finds a partner is
its coverage; a license is found where coverage reaches ``COVERAGE``,
at every passage that overlaps no better one of the same license.

Only windows that can reach it are aligned.  A window has the template's
size and some slack on both sides.  No alignment matches more words than
a window and the template have in common, each counted as often as in
both, so a window with fewer than coverage asks for is left out; this
is exact.  If a text may lack k of the template's words, the rarest ones
whose counts exceed k cannot all be missing from a passage that is
found, so only windows that hold one of those are counted at all.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linefeed.llm.common import ship, slices, texts
from linefeed.llm.decontaminate import words_of

COVERAGE = 0.8

#: Notices and license texts as their publishers word them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU General Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": "Released under the MIT License.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    pile: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            pile.append(i)
        else:
            tops[k], pile[k] = v, i
        back[i] = pile[k - 1] if k else -1
    out, at = [], pile[-1] if pile else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Matched places (text, template), ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {text[i]: i for i in range(a, b) if here[text[i]] == 1}
        pairs = [(place[template[j]], j) for j in range(c, d) if there[template[j]] == 1 and template[j] in place]
        anchors = [pairs[k] for k in increasing([i for i, _ in pairs])]
        out.extend(anchors)
        for i, j in [*anchors, (b, d)] if anchors else []:
            gaps.append((a, i, c, j))
            a, c = i + 1, j + 1
    return sorted(out)


class Templates:
    """Templates split into words once."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.words = {name: words_of(t) for name, t in sorted(templates.items()) if words_of(t)}
        self.counts = {name: Counter(w) for name, w in self.words.items()}
        #: Fewest words matched that are the coverage wanted.
        self.need = {name: next((k for k in range(len(w)) if k / len(w) >= coverage), len(w))
                     for name, w in self.words.items()}
        self.all = frozenset().union(*self.counts.values()) if self.counts else frozenset()

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """Name, coverage and words spanned of each license notice found, passages of a license in order."""
        words = words_of(text)
        held = self.all.intersection(words)
        found = []
        places: dict[bytes, list[int]] | None = None
        for name, counts in self.counts.items():
            missing = sum(n for w, n in counts.items() if w not in held)
            if missing > len(self.words[name]) - self.need[name]:
                continue
            if places is None:
                places = {}
                for i, w in enumerate(words):
                    if w in held:
                        places.setdefault(w, []).append(i)
            found.extend((name, *p) for p in self._passages(words, name, places))
        return found

    def windows(self, length: int, name: str, places: dict[bytes, list[int]]) -> list[tuple[int, int]]:
        """The windows of a text with enough words in common with a template, ascending."""
        counts, n, need = self.counts[name], len(self.words[name]), self.need[name]
        size = n + 2 * (n // 4 + 2)
        here = {w: np.array(places[w]) for w in counts if w in places}
        left = n - need - sum(k for w, k in counts.items() if w not in here)
        rare: list[np.ndarray] = []
        for w in sorted(here, key=lambda w: (len(here[w]), w)):
            if left < 0:
                break
            rare.append(here[w])
            left -= counts[w]
        # windows that hold a rare word: those that begin up to a window's size before it
        edge = np.zeros(size + length + 1, np.int64)
        for p in rare:
            np.add.at(edge, p, 1)
            np.add.at(edge, p + size, -1)
        low = np.flatnonzero(np.cumsum(edge)) - size + 1
        common = np.zeros(len(low), np.int64)
        for w, p in here.items():
            common += np.minimum(np.searchsorted(p, low + size) - np.searchsorted(p, low), counts[w])
        return [(max(0, a), a + size) for a in low[common >= need].tolist()]

    def _passages(self, words, name, places) -> list[tuple[float, int, int]]:
        own, reached = self.words[name], set()
        for low, high in self.windows(len(words), name, places):
            matched = align(words[low:high], own)
            if matched and len(matched) >= self.need[name]:
                reached.add((len(matched) / len(own), low + matched[0][0], low + matched[-1][0] + 1))
        # the best first, then the shortest, then the first; none that overlaps one taken
        taken: list[tuple[int, int, float]] = []
        for cover, a, b in sorted(reached, key=lambda p: (-p[0], p[2] - p[1], p[1])):
            k = bisect_left(taken, (a,))
            if (not k or taken[k - 1][1] <= a) and (k == len(taken) or b <= taken[k][0]):
                taken.insert(k, (a, b, cover))
        return [(cover, a, b) for a, b, cover in taken]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row and license notice found: ``doc_id, license, coverage, first_word, end_word``.

    A notice that a text holds several times has a row each.  Words are counted from 0, the end is not included.  Null, empty or
    other texts without a license have no rows; repeated rows repeat theirs.
    """
    ship(docs.sparkSession)
    held = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(held, coverage)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(i, *f) for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                                                strict=True) for f in known.find(t)]
                yield pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, r, strict=True)) for r in rows], schema=_FOUND)

    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, license string, coverage double, first_word int, end_word int")


_FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()),
                    ("first_word", pa.int32()), ("end_word", pa.int32())])
