"""Operator 1: recall of edited passages, exact verification, and rows that go wrong."""

from __future__ import annotations

import random

import pytest

from linefeed.llm import decontaminate as dc
from linefeed.llm.common import table


@pytest.fixture(scope="module")
def items(spark, sf_small):
    return [(r["item_id"], r["text"]) for r in table(spark, sf_small, "benchmark").collect()]


def test_fewest_edits():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randint(0, 3) for _ in range(rng.randint(1, 8))]
        text = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        best, row = (len(item), 0), list(range(len(item) + 1))
        for j, w in enumerate(text):
            new = [0]
            for i in range(1, len(item) + 1):
                new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (item[i - 1] != w)))
            row = new
            best = min(best, (row[-1], j + 1))
        assert dc.fewest_edits(item, text) == best


@pytest.mark.parametrize("edits, least", [(0.0, 1.0), (0.05, 0.97), (0.1, 0.95)])
def test_recall_of_edited_passages(items, edits, least):
    rng, held = random.Random(2), dc.Items([i for i, _ in items], [t for _, t in items])
    found = total = 0
    for k, (_, text) in enumerate(items * 4):
        own = text.split()
        for _ in range(int(edits * len(own))):
            p = rng.randrange(len(own))
            own[p:p + 1] = rng.choice([[], ["zq%d" % rng.randint(0, 9999)], [own[p], "zz"]])
        doc = " ".join(["pre%d" % rng.randint(0, 99) for _ in range(30)] + own + ["post"] * 9)
        total += 1
        found += k % len(items) in held.find([doc])[0]
    assert found >= least * total


def test_against_brute_force(spark, rows, items):
    part = rows[:60] + [(900, "x y " + items[0][1].upper().replace(" ", "!! ") + " z")]
    got = dc.leaks(spark.createDataFrame(part, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got.collect()} == dc.brute_force(part, items)
    assert any(r["doc_id"] == 900 and r["first_word"] == 2 for r in got.collect())


def test_blocks_of_items_find_the_same(spark, docs, items):
    frame = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, dc.leaks(docs, frame).collect()))
    assert one and one == sorted(map(tuple, dc.leaks(docs, frame, block_items=9).collect()))


def test_edge_rows(spark, edge, empty):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (None, "a b c d e f"),
                                   (3, ""), (4, "one")], "item_id long, text string")
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in dc.leaks(edge, items).collect()) == [
        (0, 1), (1, 1), (2, 1), (2, 1), (8, 4)]
    assert dc.leaks(empty, items).count() == 0
    none = items.where("item_id = 99")
    assert dc.leaks(edge, none).count() == 0 and dc.without_leaks(edge, none).count() == edge.count()
    left = dc.without_leaks(edge, items)
    assert left.columns == edge.columns and {r["doc_id"] for r in left.collect()} == {3, 4, 5, 6, 7}


@pytest.mark.parametrize("size", [5, 6, 8, 10, 15, 20, 40])
def test_recall_in_mid_document_at_every_length(rows, size):
    rng = random.Random(size)
    texts = [w for w in (dc.words_of(t or "") for _, t in rows) if len(w) > 60]

    def stretch(n):
        own = rng.choice(texts)
        at = rng.randrange(len(own) - n)
        return [w.decode() for w in own[at:at + n]]

    items = [stretch(size) for _ in range(200)]
    held = dc.Items(list(range(200)), [" ".join(i) for i in items])
    for edits, least in ((0.0, 1.0), (0.1, 0.98), (0.2, 0.96)):
        docs = []
        for item in items:
            own = list(item)
            for _ in range(int(edits * size)):
                p = rng.randrange(len(own))
                own[p:p + 1] = rng.choice([[], ["zq%d" % rng.randint(0, 9999)], [own[p], "zz"]])
            docs.append(" ".join(stretch(40) + own + stretch(40)))
        assert sum(i in found for i, found in enumerate(held.find(docs))) >= least * 200


SHORT = [(1, "what is pi exactly"), (2, "圆周率的精确值是多少"), (3, "Pi?"), (4, "ราคาเท่าไหร่"), (5, "日本で一番高い山は何ですか。"),
         (6, "naïve café"), (7, "... !!"), (8, "two words"), (9, "三個字")]


def test_short_and_unspaced_items_are_found(spark):
    docs = [(i, f"und so weiter {t.upper()} and more of it") for i, t in SHORT]
    docs += [(20, "我想知道圆周率的精确值是多少吗"), (21, "ถามว่าราคาเท่าไหร่ครับ"), (22, "日本で一番高い山は、何ですか"),
             (23, "what is pie exactly"), (24, "圆周率的值"), (25, "twowords two"), (26, "圆周率的精切值是多少"), (27, "三 個 字")]
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(SHORT, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in dc.leaks(*frames).collect()}
    assert got == dc.brute_force(docs, SHORT)
    found = {(i, k) for i, k, _ in got}
    assert {(i, i) for i, _ in SHORT if i != 7} | {(20, 2), (21, 4), (22, 5), (26, 2), (27, 9)} <= found
    assert not found & {(23, 1), (24, 2), (25, 8)} and not any(k == 7 for _, k in found)
    kept = {r["doc_id"] for r in dc.without_leaks(*frames, block_items=3).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in found}
    longer = {(r["doc_id"], r["item_id"]) for r in dc.leaks(*frames, least_words=5).collect()}
    assert longer == {(i, k) for i, k in found if k in (2, 4, 5)}


@pytest.mark.parametrize("script", ["ideographs", "two words", "Thai"])
def test_recall_by_script_and_length(script):
    rng = random.Random(3)
    letters = {"ideographs": range(0x4E00, 0x5200), "Thai": range(0xE01, 0xE2F), "two words": range(0x61, 0x7B)}[script]
    size = 2 if script == "two words" else 20

    def unit():
        return " " + "".join(chr(rng.choice(letters)) for _ in range(6)) if script == "two words" else chr(
            rng.choice(letters))

    items = [[unit() for _ in range(size)] for _ in range(200)]
    held = dc.Items(list(range(200)), ["".join(i) for i in items])
    for edits in (0, int(.1 * size), int(.2 * size)):
        docs = []
        for item in items:
            own = list(item)
            for _ in range(edits):
                p = rng.randrange(len(own))
                own[p:p + 1] = rng.choice([[], [unit()], [own[p], unit()]])
            docs.append("".join([*[unit() for _ in range(40)], *own, *[unit() for _ in range(40)]]))
        assert sum(i in found for i, found in enumerate(held.find(docs))) >= (0.97 if edits else 1.0) * 200
