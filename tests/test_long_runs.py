"""What larger tables must not meet: work done twice, casts that fail for every row, a stream cut off at work."""

from __future__ import annotations

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from linefeed import queries as Q
from linefeed.functions import columns as C
from linefeed.operators.expand import flatten_snapshots
from linefeed.sources.snapshots import stream_snapshots
from linefeed.streaming.ingest import _run


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_slots_and_cars_are_parsed_once(spark):
    docs = spark.createDataFrame([(json.dumps({"lane_1": {"fb": {
        "s1": {"CAR": {"KNR": "1"}, "LANE": None, "TACT": "T1"}, "s2": {"CAR": {}}, "s3": {"CAR": 5}, "s4": 7,
        "s5": {"TACT": "T2"}, "s6": {"CAR": None}, "s7": {"CAR": {"KNR": "2"}}}}}),)], "value string")
    cars = flatten_snapshots(docs)
    assert optimized(cars).count("from_json(") == 5  # document, lane, feeder, slot and car
    assert sorted((r["knr"], r["lane"], r["takt"]) for r in cars.collect()) == [("1", None, "T1"), ("2", "lane_1", None)]


def test_a_unit_without_a_digit_is_not_cast(spark, sf_small):
    # the cast of a unit stands behind a look for a digit
    clean = optimized(Q.QUERIES["fx4pd_clean"](spark, sf_small)).split("Filter")[0]
    assert "[0-9])" in clean and "RLIKE" in clean
    values = ["1", "ST", "3.0", None, "", "-7", "+7", "7 ", ".", "5.", "A1", "2147483648", "٥", "-"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    found = df.select(C.lenient_int("x", 9).alias("a"), F.coalesce(F.col("x").try_cast("int"), F.lit(9)).alias("b"))
    assert all(r["a"] == r["b"] for r in found.collect())


def landed(spark, base):
    os.makedirs(f"{base}/landing")
    with open(f"{base}/landing/a.json", "w") as f:
        f.write("{}\n")
    return stream_snapshots(spark, f"{base}/landing")


def test_a_stream_at_work_is_not_cut_off(spark):
    base, done = tempfile.mkdtemp(prefix="linefeed-long-"), []

    def slow(batch, batch_id):
        spark.range(0, 1, 1, 1).foreach(lambda _: time.sleep(15))
        done.append(batch_id)

    _run(landed(spark, base), slow, f"{base}/checkpoint", 8)
    assert done == [0]


def test_a_stream_that_stands_still_is_an_error(spark):
    base = tempfile.mkdtemp(prefix="linefeed-still-")
    with pytest.raises(TimeoutError):
        _run(landed(spark, base), lambda *_: time.sleep(12), f"{base}/checkpoint", 2)
