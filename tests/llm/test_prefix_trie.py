"""Operator 12: the trie against SQL and against a brute-force version, with light and heavy subtries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linefeed.llm import prefix_trie
from linefeed.llm.queries import op12_prefix_trie
from tests.harness import compare, duck_connection

SCHEMA = "conv_id long, turn long, role string, text string"
#: Nulls everywhere, equal turns, repeated rows, a family without its first one, a conversation of system turns alone.
EDGE = [(20, 0, "user", "hi there"), (20, 1, "assistant", "hello"), (20, None, None, None), (21, 0, "user", "x y"),
        (21, 0, "user", "x y"), (21, 0, "user", "a"), (22, 5, "user", ""), (22, 6, None, "z"), (None, 0, "user", "who"),
        (41, 0, "user", "no base"), (41, 1, "user", "no\x0bbase two\x00three"), (43, 0, "u", "one"),
        (-7, 0, "user", "below zero"), (-7, 1, "a", "two"), (-7, 2, "a", "two"), (0, 0, "user", "first"),
        (1, None, "user", "é\U0001f600"), (1, None, "user", "b"), (2, 0, "user", "first"), (60, 3, "user", "long " * 5000)]


def got(frame, **more):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame, **more).collect()), key=str)


def generated(n=120, seed=3):
    """Conversations that share first turns, repeat as a whole and differ in their last turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        words = ["same", "first"] if c % 3 else [str(rng.randrange(4))]
        for t in range(rng.choice((1, 2, 3, 5, 12))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", " ".join(words * (1 + t % 3))))
            words = ["same"] if rng.random() < .7 else [str(rng.randrange(3))]
    return rows


def test_against_duckdb(spark, sf_small):
    found = compare(op12_prefix_trie(spark, sf_small), duck_connection(sf_small), prefix_trie.ORACLE)
    assert found["hash_match"] and found["schema_match"]


@pytest.mark.parametrize("rebuilt", [True, False])
def test_edge_rows_and_clashing_columns(spark, rebuilt):
    frame = spark.createDataFrame(EDGE, SCHEMA).withColumns(
        {c: F.lit(c) for c in ("pos", "depth", "a", "b", "place", "words", "length", "digest", "n", "h", "base")})
    assert got(frame, rebuilt=rebuilt) == sorted(prefix_trie.brute_force(EDGE, rebuilt), key=str)


def test_edge_rows_against_duckdb(spark, tmp_path):
    frame = spark.createDataFrame(EDGE, SCHEMA)
    path = str(tmp_path / "conversations.parquet")
    frame.coalesce(1).write.parquet(path)
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert compare(prefix_trie.prefix_trie(frame), con, prefix_trie.ORACLE)["hash_match"]


@pytest.mark.parametrize("light", [1, 25, 20_000])
def test_light_and_heavy_subtries(spark, light):
    rows = generated()
    assert got(spark.createDataFrame(rows, SCHEMA), light=light) == sorted(prefix_trie.brute_force(rows), key=str)


def test_long_conversations_cross_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    rows = [(c, t, "user", f"turn {t if t < 20 + c % 3 else c % 4}") for c in range(1, 30) for t in range(30)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == sorted(prefix_trie.brute_force(rows), key=str)


def test_crown_by_levels_is_the_crown_in_one_task(spark, monkeypatch):
    rows = generated(40, 9)
    frame = spark.createDataFrame(rows, SCHEMA)
    crowns = []
    by_levels = prefix_trie._crown_by_levels
    monkeypatch.setattr(prefix_trie, "_crown_by_levels", lambda crown: crowns.append(crown) or by_levels(crown))
    assert got(frame, light=2) == sorted(prefix_trie.brute_force(rows), key=str)
    assert crowns
    crown = crowns[0]
    in_one = crown.groupBy().applyInArrow(prefix_trie._peel_crown, prefix_trie.NODE)
    assert sorted(map(str, in_one.collect())) == sorted(map(str, by_levels(crown).collect()))


def test_no_rows(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)) == []
