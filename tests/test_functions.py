"""F1-F16 on the edge rows of FIXTURES.md §2."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linefeed.functions import columns as C


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_box_count(spark):
    values = ["MAX: 12", "max 5", "8", "n/a", None, "1 2", "9" * 20]
    assert one_col(spark, values, C.box_count) == [12, 5, 8, 0, 0, 12, 0]


def test_part_number(spark):
    values = [" p.1 ", "1k0.123-a_b", "p#1", "p 1", "é1", None]
    assert one_col(spark, values, C.part_number) == ["P1", "1K0123-A_B", "P1", "P1", "É1", None]


def test_part_number_equals_literal_chain(spark):
    """The single regex equals strip -> drop \\s+ -> drop '.' -> drop [^\\w-] -> upper."""
    import re
    samples = [" a.b c-d_e ", "x\ty.z", "..--__", "mixed #1 / 2", "ünï.cödé"]
    chain = [re.sub(r"[^\w-]", "", re.sub(r"\.", "", re.sub(r"\s+", "", s.strip()))).upper()
             for s in samples]
    assert one_col(spark, samples, C.part_number) == chain


def test_rack_and_takt(spark):
    assert one_col(spark, ["LB P12B P3", "STOP1", "p12", None], C.rack) == ["P12B", "P1", None, None]
    assert one_col(spark, ["LINHA T07 X", "PT100", "sem takt"], C.takt) == ["T07", "T100", None]


def test_lenient_double_and_usage_filter(spark):
    kept = ["1.5", " 2 ", "1e3", "5.", ".5", "NaN", "-inf"]
    dropped = ["1,5", "abc", "", "1.5d", "1.5f"]
    got = one_col(spark, kept + dropped, C.lenient_double)
    assert all(v is not None for v in got[:len(kept)])
    assert got[len(kept):] == [None] * len(dropped)
    assert got[:5] == [1.5, 2.0, 1000.0, 5.0, 0.5]


def test_lenient_int(spark):
    assert one_col(spark, ["1", "ST", "3.0", None], C.lenient_int) == [1, 0, 0, 0]


def test_remove_first_lane(spark):
    got = one_col(spark, ["lane_1", "lane_a_lane_b", "reception", "x.lane_"],
                  lambda c: C.remove_first(c, "lane_"))
    assert got == ["1", "a_lane_b", "reception", "x."]


def test_car_key_null_propagates(spark):
    df = spark.createDataFrame([("38", "1", "0000001"), (None, "1", "0000002")],
                               "werk string, spj string, knr string")
    got = [r[0] for r in df.select(C.car_key("werk", "spj", "knr")).collect()]
    assert got == ["3810000001", None]


def test_floor_ratio(spark):
    df = spark.createDataFrame([(24, 3.0, 6), (10, 1.0, 0), (7, 0.0, None)],
                               "total long, lb double, per long")
    got = [r[0] for r in df.select(C.floor_ratio(F.col("total") - F.col("lb"), "per")).collect()]
    assert got == [3, None, None]


def test_strip_string_columns_only_touches_strings(spark):
    df = spark.createDataFrame([(" a b ", 1, " c")], "s string, n int, t string")
    assert C.strip_string_columns(df).first() == ("ab", 1, "c")


def test_day_text_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 7),)], "d date")
    row = df.select(C.day_text("d").alias("t")).select("t", C.parse_day("t").alias("d")).first()
    assert row["t"] == "07.03.2024" and row["d"] == dt.date(2024, 3, 7)


def test_blank_and_contains(spark):
    df = spark.createDataFrame([("  ",), ("X_LT22",), (None,)], "n string")
    got = df.select(C.is_blank("n"), C.contains_ci("n", "lt22")).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (True, None)]


@pytest.mark.parametrize("text", ["ß"])
def test_upper_sharp_s(spark, text):
    # Spark upper-cases ß to SS (DuckDB gives ẞ, so oracle data avoids it)
    assert one_col(spark, [text], C.part_number) == ["SS"]


def test_fill_null(spark):
    assert one_col(spark, [None, "x"], lambda c: C.fill_null(c, "-")) == ["-", "x"]
