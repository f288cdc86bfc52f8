"""Operator 5: counts against brute force; the order of the rules does not change a verdict."""

from __future__ import annotations

import random
import re
from collections import Counter

from linefeed.llm import quality


def repeated(words, window=8):
    count = Counter(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    cover = set()
    for i in range(len(words) - window + 1):
        if count[tuple(words[i:i + window])] > 1:
            cover.update(range(i, i + window))
    return len(cover)


def test_repeated_words():
    rng = random.Random(1)
    for _ in range(1500):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        assert quality.repeated_words(words) == repeated(words)


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = repeated(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), again,
            len(words) < 20 or 100 * again > 30 * len(words))


def test_base_counts(spark, rows, edge):
    for frame, data in ((spark.createDataFrame(rows, "doc_id long, text string"), rows),
                        (edge, [(r["doc_id"], r["text"]) for r in edge.collect()])):
        got = quality.quality(frame).drop("kept").collect()
        assert sorted(map(tuple, got), key=str) == sorted(((i, *counts(t or "")) for i, t in data), key=str)


def test_order_does_not_change_the_verdict(docs):
    def verdict(rules):
        return {r["doc_id"]: r["rejected_by"] is None for r in quality.cascade(docs, rules).collect()}
    assert verdict(quality.RULES) == verdict(quality.RULES[::-1])


def test_rules_are_ordered_by_rejections_per_cost(docs):
    figures = [(r.name, float(i + 1), 0.5) for i, r in enumerate(quality.RULES)]
    assert quality.ordered(quality.RULES[::-1], figures) == quality.RULES
    assert {n for n, _, _ in quality.measured(docs)} == {r.name for r in quality.RULES}


def test_good_documents_are_kept_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Counter((r["quality"], r["kept"]) for r in quality.quality(docs).join(labels, "doc_id").where(
        "n_words >= 20").collect())
    assert got[1, False] <= 0.02 * got[1, True] and got[0, True] <= 0.1 * got[0, False]


def test_no_rows(empty):
    assert quality.quality(empty).count() == 0
