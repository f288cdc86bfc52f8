"""Operator 6: alignment properties, planted licenses, and rows that go wrong."""

from __future__ import annotations

import random
from itertools import combinations

from linefeed.llm import licenses as lic


def test_longest_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        values = rng.sample(range(20), rng.randint(0, 9))
        got = [values[i] for i in lic.increasing(values)]
        best = max((k for k in range(len(values) + 1) for c in combinations(values, k) if list(c) == sorted(c)), default=0)
        assert got == sorted(got) and len(got) == best


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in "ab")
        pairs = lic.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
    assert len(lic.align(list("xyzabc"), list("abc"))) == 3


def test_planted_licenses_are_found():
    known, rng = lic.Templates(lic.TEMPLATES), random.Random(3)
    for name, text in lic.TEMPLATES.items():
        words = text.split()
        if len(words) > 20:
            for _ in range(len(words) // 12):
                words[rng.randrange(len(words))] = "changed"
        found = {f[0] for f in known.find("the of and this " * 50 + " ".join(words) + " to the license of all" * 20)}
        assert name in found
    assert known.find("all the rights of the people are reserved in the text of a license under the law") == []


def test_edge_rows(spark, edge, empty):
    assert lic.scan(edge).count() == 0 and lic.scan(empty).count() == 0
    more = spark.createDataFrame([(1, "x\nReleased under the MIT License."), (1, "x\nReleased under the MIT License."),
                                  (None, "All rights RESERVED")], "doc_id long, text string")
    assert sorted(((r["doc_id"] or 0), r["license"], r["first_word"]) for r in lic.scan(more).collect()) == [
        (0, "all-rights-reserved", 0), (1, "mit", 1), (1, "mit", 1)]
    assert lic.scan(more, {}).count() == 0


def test_pruned_windows_lose_no_license():
    known, rng = lic.Templates(lic.TEMPLATES | {"ten": "one two three four five one two three four six"}), random.Random(4)
    for text in ("Licensed under the MIT License", "x y Distributed under the MIT License. z released"):
        assert ("mit", 0.8) in {f[:2] for f in known.find(text)}
    for _ in range(60):
        name = rng.choice(sorted(known.words))
        own = list(known.words[name])
        for _ in range(rng.randint(0, len(own) // 4 + 1)):
            own[rng.randrange(len(own))] = rng.choice([b"changed", rng.choice(own)])
        around = [rng.choice([b"the", b"of", b"other", rng.choice(own)]) for _ in range(40)]
        words = around[:20] + own + around[20:]
        found = {f[0] for f in known.find(b" ".join(words).decode())}
        for name, template in known.words.items():
            n = len(template)
            slack = n // 4 + 2
            size = n + 2 * slack
            best = max(len(lic.align(words[max(0, a):a + size], template)) for a in range(1 - size, len(words)))
            assert (best / n >= lic.COVERAGE) == (name in found)


def test_every_notice_of_a_text_is_found():
    known = lic.Templates(lic.TEMPLATES)
    text = "All rights reserved. " * 2 + "some words between them " * 9 + lic.TEMPLATES["isc"] + " x " * 40 + lic.TEMPLATES["isc"]
    found = known.find(text + " All rights reserved.")
    assert [f[2:] for f in found if f[0] == "all-rights-reserved"] == [(0, 3), (3, 6), (len(lic.words_of(text)), len(lic.words_of(text)) + 3)]
    n = len(lic.words_of(lic.TEMPLATES["isc"]))
    assert [f[1:] for f in found if f[0] == "isc"] == [(1.0, 42, 42 + n), (1.0, 82 + n, 82 + 2 * n)]
