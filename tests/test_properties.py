"""
keyed update never changes the target's row count or keys."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefeed.functions import columns as C
from linefeed.operators.merge import update_by_key

ALPHABET = st.sampled_from(list("abcXYZ019 :.-_#/\t") + ["max", "MAX", "é", " ", "lane_"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=8).map("".join), min_size=1, max_size=15)
SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def box_count_chain(s):
    if s is None:
        return 0
    digits = re.sub(r"\D+", "", re.sub(r"[ :]", "", re.sub(r"(?i)max", "", s)))
    # a 64-bit parse of ASCII digits, as the source system's lenient cast
    if not digits or not digits.isascii() or int(digits) >= 2 ** 63:
        return 0
    return int(digits)


def part_number_chain(s):
    out = re.sub(r"[^\w-]", "", re.sub(r"\.", "", re.sub(r"\s+", "", s.strip())))
    return out.upper()


def spark_values(spark, texts, fn):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@SETTINGS
@given(TEXTS)
def test_box_count_equals_chain(spark, texts):
    assert spark_values(spark, texts, C.box_count) == [box_count_chain(t) for t in texts]


@SETTINGS
@given(TEXTS)
def test_part_number_equals_chain(spark, texts):
    assert spark_values(spark, texts, C.part_number) == [part_number_chain(t) for t in texts]


@SETTINGS
@given(TEXTS)
def test_remove_first_equals_replace_once(spark, texts):
    got = spark_values(spark, texts, lambda c: C.remove_first(c, "lane_"))
    assert got == [t.replace("lane_", "", 1) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.floats(-5, 5)), max_size=10))
def test_update_keeps_row_count_and_keys(spark, source_rows):
    target = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0),
                                    (None, "z", 4.0)], "k string, area string, bal double")
    source = spark.createDataFrame(
        [(k, v, i) for i, (k, v) in enumerate(source_rows)], "k string, bal double, ord long")
    out = update_by_key(target, source, "k", order_by=["ord"])
    before = sorted(((r.k or ""), r.area) for r in target.collect())
    after = sorted(((r.k or ""), r.area) for r in out.collect())
    assert before == after
