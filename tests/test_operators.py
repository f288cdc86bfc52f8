"""Row generators, projections, dense index, ordered operators and joins."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from linefeed.operators.expand import flatten_snapshots, repeat_rows
from linefeed.operators.index import with_dense_index
from linefeed.operators.joins import fits_broadcast, join_dimension
from linefeed.operators.ordered import first_match_in_list, preview
from linefeed.operators.projection import select_positions, select_renamed
from linefeed.plans.assembly import assembly_records

SNAPSHOT = {
    "lane_1": {"fb1": {"s1": {"CAR": {"KNR": "0000001", "MODELL": "M", "LFDNR": 7, "WERK": "38",
                                      "SPJ": "1"}, "LANE": "lane_1", "TACT": "T7"},
                       "s2": {"CAR": {}}, "s3": {"CAR": None}, "s4": 5}},
    "reception": {"fb1": {"s1": {"CAR": {"KNR": "0000002"}, "TACT": "T1"}}},
    "meta": 3,
}


def docs(spark, *objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "value string")


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", -2), ("d", None)], "k string, n long")
    got = sorted(tuple(r) for r in repeat_rows(df, "n").select("k", "call_no").collect())
    assert got == [("a", 1), ("a", 2), ("a", 3)]


def test_flatten_fixture_document(spark):
    rows = assembly_records(docs(spark, SNAPSHOT)).orderBy("knr").collect()
    assert len(rows) == 2
    first, second = rows
    assert (first.lane, first.lfdnr_sequence, first.takt, first.knr_fx4pd) == \
        ("1", "7", "T7", "3810000001")
    assert second.lane == "reception" and second.werk is None and second.knr_fx4pd is None


def test_flatten_tolerates_non_objects(spark):
    odd = {"lane_2": "not an object", "lane_3": {"fb": 7},
           "lane_4": {"fb": {"s": {"CAR": {"KNR": "9"}, "LANE": None, "TACT": "T2"}}},
           "other": {"fb": {"s": {"CAR": {"KNR": "8"}}}}}
    rows = flatten_snapshots(docs(spark, odd)).collect()
    assert [(r.knr, r.lane, r.takt) for r in rows] == [("9", None, "T2")]


def test_flatten_empty_keeps_schema(spark):
    out = assembly_records(docs(spark, {"meta": 1}))
    assert out.count() == 0
    assert out.columns == ["knr", "model", "lfdnr_sequence", "werk", "spj", "lane", "takt",
                           "knr_fx4pd"]


def test_select_renamed_and_positions(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6, 7)], "a int, `b.c` int, c int, d int, e int, f int, g int")
    assert select_renamed(df, {"g": "x", "b.c": "y"}).columns == ["x", "y"]
    assert tuple(select_positions(df, {0: "k", 1: "p", 5: "u", 6: "n"}).first()) == (1, 2, 6, 7)
    with pytest.raises(ValueError):
        select_renamed(df, {"missing": "x"})
    with pytest.raises(ValueError):
        select_positions(df.select("a", "c"), {0: "k", 6: "n"})


@pytest.mark.parametrize("parts", [3, 11])
def test_dense_index_matches_row_number(spark, parts):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"),
                                     (F.col("id") % 13).alias("g"))
    indexed = with_dense_index(df, ["g", "k"], num_partitions=parts)
    got = sorted(tuple(r) for r in indexed.collect())
    expected = [tuple(r) for r in df.orderBy("g", "k").collect()]
    assert [g[0] for g in got] == list(range(5000))
    assert [(g[1], g[2]) for g in sorted(got)] == expected
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_dense_index_empty(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    assert with_dense_index(df, ["k"]).count() == 0


def test_preview_bounds(spark):
    df = spark.range(10)
    assert preview(df, 3).count() == 3
    for bad in (0, 100_001, "5"):
        with pytest.raises(ValueError):
            preview(df, bad)


def spool(spark, rows):
    return spark.createDataFrame(rows, "grp string, idx long, name string, hour string")


def test_first_match_skips_blanks_and_ignores_case(spark):
    rows = [("g", 0, "  ", "h0"), ("g", 1, None, "h1"), ("g", 2, "foo", "h2"),
            ("g", 3, "X_LT22", "h3"), ("g", 5, "lt22", "h5")]
    got = first_match_in_list(spool(spark, rows), "grp", "idx", "name", "lt22", ["hour"]).collect()
    assert [tuple(r) for r in got] == [("g", 3, "x_lt22", "h3")]


def test_first_match_stops_at_gap_and_needs_a_row(spark):
    rows = [("a", 0, "foo", "1"), ("a", 2, "lt22", "2"),   # gap at 1: not reached
            ("b", 0, " ", "1"), ("b", 1, "", "2")]          # only blanks: no result
    got = first_match_in_list(spool(spark, rows), "grp", "idx", "name", "lt22", ["hour"]).collect()
    assert got == []


def test_join_dimension_broadcasts_only_small_sides(spark):
    fact = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), "id")
    dim = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = join_dimension(fact, dim, "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert fits_broadcast(dim, max_rows=10) and not fits_broadcast(dim, max_rows=9)
    big = join_dimension(fact, dim, "k", max_rows=5)
    assert big.count() == small.count() == 1000


def test_flatten_repeated_keys_last_wins(spark):
    doc = ('{"lane_1": {"fb": {"s": {"CAR": {"KNR": "1"}, "TACT": "T1"}}}, '
           '"lane_1": {"fb": {"s": {"CAR": {"KNR": "2", "KNR": "3"}, "TACT": "T1", "TACT": "T9"}}}}')
    assert json.loads(doc)["lane_1"]["fb"]["s"]["TACT"] == "T9"   # Python's reading
    rows = flatten_snapshots(spark.createDataFrame([(doc,)], "value string")).collect()
    assert [(r.knr, r.takt) for r in rows] == [("3", "T9")]
