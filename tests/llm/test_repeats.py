"""Operator 9: suffix sorting and removal against brute force."""

from __future__ import annotations

import random
from bisect import bisect_left

import numpy as np

from linefeed.llm import repeats
from linefeed.llm.suffixes import Suffixes


def test_suffixes_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        raw = b"\x00".join(bytes(rng.choice(b"abab\x02") for _ in range(rng.randint(1, 30)))
                           for _ in range(rng.randint(1, 8))) + b"\x00"
        ends = [i for i, c in enumerate(raw) if c == 0]
        suffix = [(raw[i:ends[bisect_left(ends, i)]], ends[bisect_left(ends, i)]) for i in range(len(raw))]
        array = Suffixes(np.frombuffer(raw, np.uint8))
        want = sorted(range(len(raw)), key=suffix.__getitem__)
        assert array.order.tolist() == want
        for least in (1, 3, 9):  # long suffixes alone, in the same order
            some = Suffixes(np.frombuffer(raw, np.uint8), least)
            assert [i for i in some.order.tolist() if some.left[i] >= least] == [i for i in want if array.left[i] >= least]
        common = array.common_prefixes(array.order, 20)
        for k in range(1, len(want)):
            a, b = suffix[want[k]][0], suffix[want[k - 1]][0]
            n = next((j for j in range(min(len(a), len(b), 20)) if a[j] != b[j]), min(len(a), len(b), 20))
            assert common[k] == n


def test_against_brute_force(spark, rows):
    rng = random.Random(4)
    passage = "passage of more than fifty bytes that occurs again and again in documents, over and over. "
    # more documents share it than HOT_DOCS, so single windows are sent too
    more = [(10_000 + i, "x%d " % i * rng.randint(0, 9) + passage[rng.randint(0, 9):] + "é%d" % (i * 7)
             + ("aaaa" * 40 if i % 3 == 0 else "")) for i in range(repeats.HOT_DOCS + 60)]
    more += [(None, rows[3][1]), (5, rows[9][1]), (7777, None), (7778, ""), rows[0], (9999, rows[0][1]),
             (9998, "\x00" * 70 + "ab"), (9999, "b" + "\x00" * 70)]
    data = [*rows[:120], *more]
    got = repeats.repeats_digest(spark.createDataFrame(data, "doc_id long, text string"), chunk_bytes=100_000)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(repeats.brute_force(data), key=str)


def test_other_sizes(spark):
    data = [(1, "abcdefgh" * 20), (2, "xx" + "abcdefgh" * 5 + "yy"), (3, "abcdefgh" * 4)]
    for size in (32, 41):
        got = repeats.repeats_digest(spark.createDataFrame(data, "doc_id long, text string"), size)
        assert sorted(map(tuple, got.collect())) == sorted(repeats.brute_force(data, size))


def test_edge_rows(edge, empty):
    got = repeats.repeats_digest(edge).collect()
    want = repeats.brute_force([(r["doc_id"], r["text"]) for r in edge.collect()])
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert repeats.repeats_digest(empty).count() == 0


def test_names_tell_strings_apart():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3 * repeats.SLAB // 2, dtype=np.uint8)
    start = np.sort(rng.integers(0, len(data) - 80, 20_000))
    end = start + rng.integers(50, 74, len(start))
    got = repeats.names(data, start, end)
    want: dict[bytes, int] = {}
    for a, b, n in zip(start.tolist(), end.tolist(), got.tolist(), strict=True):
        assert want.setdefault(data[a:b].tobytes(), n) == n
    assert len(set(want.values())) == len(want)


def test_few_documents_with_one_very_frequent_string(spark):
    """Log-like texts: a gram that a document repeats very often is sent window by window, not to one bucket."""
    rng = random.Random(8)
    line = "2026-01-01T00:00:00Z INFO worker finished request "
    data = [(i, "\n".join(f"{line}{rng.randrange(40)}" for _ in range(900))) for i in range(4)]
    data += [(10, "unlike anything else in here, but " + line * 2), (11, line * 40)]
    chunk = repeats._Chunk(repeats.pa.table({"doc_id": [i for i, _ in data], "text": [t for _, t in data],
                                             "h": list(range(len(data)))}), set(), 50)
    _, weight = chunk.tally()
    assert weight.max() > len(data)        # runs count as documents
    got = repeats.repeats_digest(spark.createDataFrame(data, "doc_id long, text string"), chunk_bytes=60_000)
    assert sorted(map(tuple, got.collect())) == sorted(repeats.brute_force(data))


def test_frequent_strings_spread_over_buckets(monkeypatch):
    monkeypatch.setattr(repeats, "HOT_DOCS", 10)
    rng = random.Random(9)
    texts = ["\n".join(f"2026-01-01T00:00:00Z INFO worker finished request {rng.randrange(10**9)}" for _ in range(1500))
             for _ in range(4)]
    chunk = repeats._Chunk(repeats.pa.table({"doc_id": [0, 1, 2, 3], "text": texts, "h": [0, 1, 2, 3]}), set(), 50)
    cut, weight = chunk.tally()
    chunk.pieces(cut, np.minimum(weight, 255).astype(np.uint8), 16)
    load = np.bincount(chunk.bucket, weights=chunk.piece_end - chunk.piece_start, minlength=16)
    assert load.max() < 2 * load.mean()
