"""K1 upsert, K2 keyed update, A2 last-per-key, K4 table names (FIXTURES.md §2)."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linefeed.operators.merge import check_table_name, last_per_key, update_by_key, upsert

TARGET = "k string, a long, b string, keep double"
SOURCE = "k string, a long, b string, ord long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bmax", [0, 100])
def test_upsert_rules(spark, bmax):
    target = spark.createDataFrame([("x", 1, "t1", 9.0), ("y", 2, "t2", 8.0), ("z", 3, "t3", 7.0)],
                                   TARGET)
    source = spark.createDataFrame([("x", None, "s1", 1),     # match, NULL overwrites
                                    ("y", 20, "old", 1), ("y", 21, "new", 2),  # last by ord
                                    ("n", 5, "s5", 1),         # new key
                                    (None, 6, "s6", 1)],       # NULL key: inserted
                                   SOURCE)
    got = rows(upsert(target, source, ["k"], order_by=["ord"], broadcast_max_rows=bmax))
    assert got == sorted([("x", None, "s1", 9.0), ("y", 21, "new", 8.0), ("z", 3, "t3", 7.0),
                          ("n", 5, "s5", None), (None, 6, "s6", None)], key=repr)


@pytest.mark.parametrize("bmax", [0, 100])
def test_upsert_null_safe_and_flagged(spark, bmax):
    schema = "k string, n long, v string"
    target = spark.createDataFrame([("a", 1, "t"), (None, 1, "t"), ("b", None, "t"), ("c", 2, "t")], schema)
    source = spark.createDataFrame([(None, 1, "x"), (None, 1, "y"), ("b", None, "z"), (None, None, "w"), ("a", 1, "u")],
                                   schema)
    merged = upsert(target, source, ["k", "n"], broadcast_max_rows=bmax, null_keys="match", flag="did")
    assert rows(merged) == sorted([("a", 1, "u", "updated"), (None, 1, "y", "updated"), ("b", None, "z", "updated"),
                                   ("c", 2, "t", "unchanged"), (None, None, "w", "inserted")], key=repr)
    again = upsert(merged.drop("did"), source, ["k", "n"], broadcast_max_rows=bmax, null_keys="match")
    assert rows(again) == rows(merged.drop("did"))
    kept = upsert(target, source, ["k", "n"], broadcast_max_rows=bmax, flag="did")
    assert sorted(r["did"] for r in kept.collect()) == ["inserted"] * 4 + ["unchanged"] * 3 + ["updated"]


def test_update_by_key_flags_rows(spark):
    target = spark.createDataFrame([("p1", 1.0), ("p1", 2.0), ("p2", 3.0), (None, 4.0)], "part string, bal double")
    source = spark.createDataFrame([("p1", 9.0), ("zz", 5.0), (None, 7.0)], "part string, bal double")
    assert rows(update_by_key(target, source, "part", flag="did")) == sorted(
        [("p1", 9.0, "updated"), ("p1", 9.0, "updated"), ("p2", 3.0, "unchanged"), (None, 4.0, "unchanged")], key=repr)


def test_upsert_empty_source_and_errors(spark):
    target = spark.createDataFrame([("x", 1, "t1", 9.0)], TARGET)
    empty = spark.createDataFrame([], "k string, a long")
    assert rows(upsert(target, empty, ["k"])) == [("x", 1, "t1", 9.0)]
    with pytest.raises(ValueError):
        upsert(target, spark.createDataFrame([("x", 1)], "k string, other long"), ["k"])
    with pytest.raises(ValueError):
        upsert(target, empty, ["missing"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.integers(0, 3)),
                max_size=12))
def test_upsert_idempotent_and_row_count(spark, src_rows):
    target = spark.createDataFrame([("a", 1, "t", 1.0), ("e", 2, "t", 2.0)], TARGET)
    source = spark.createDataFrame([(k, a, "s", o) for k, a, o in src_rows], SOURCE)
    once = upsert(target, source, ["k"], order_by=["ord"])
    twice = upsert(once, source, ["k"], order_by=["ord"])
    assert rows(once) == rows(twice)
    assert once.count() == len({"a", "e"} | {k for k, _, _ in src_rows})
    kept = {r["k"]: r["keep"] for r in once.collect()}
    assert kept["a"] == 1.0 and kept["e"] == 2.0


def test_update_by_key_rules(spark):
    target = spark.createDataFrame([("p1", "A1", 10.0), ("p1", "A2", 11.0), ("p2", "A1", 12.0),
                                    (None, "A3", 13.0)],
                                   "part string, area string, bal double")
    source = spark.createDataFrame([("p1", 1.0, 1), ("p1", 2.0, 2), ("zz", 5.0, 1), (None, 7.0, 1)],
                                   "part string, bal double, ord long")
    got = rows(update_by_key(target, source, "part", order_by=["ord"]))
    assert got == sorted([("p1", "A1", 2.0), ("p1", "A2", 2.0), ("p2", "A1", 12.0),
                          (None, "A3", 13.0)], key=repr)
    with pytest.raises(ValueError):
        update_by_key(target, source.drop("part"), "part")
    with pytest.raises(ValueError):
        update_by_key(target, source.select("part"), "part")


def test_last_per_key_total_order(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "a"), (1, 5, "b"), (2, None, "x"),
                                (None, 1, "k")], "key long, ts long, v string")
    got = rows(last_per_key(df, ["key"], ["ts"]))
    assert got == sorted([(1, 5, "b"), (2, None, "x"), (None, 1, "k")], key=repr)
    with pytest.raises(ValueError):
        last_per_key(df, ["key"], [])


@pytest.mark.parametrize("name,ok", [("pkmc", True), ("assembly_line", True), ("t1", True),
                                     ("_", False), ("", False), ("a-b", False), ("x;drop", False)])
def test_table_names(name, ok):
    if ok:
        assert check_table_name(name) == name
    else:
        with pytest.raises(ValueError):
            check_table_name(name)
