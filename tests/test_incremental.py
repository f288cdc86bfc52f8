"""The forecast kept up to date equals J1 done anew, whatever changed; untouched bands are not rewritten."""

from __future__ import annotations

import os
import random
import tempfile

import pytest

import fixtures as X
from linefeed.plans import forecast, incremental, jobs

DEMAND = "knr_fx4pd string, partnumber string, qty_usage double, qty_unit int"
CYCLES = ("partnumber string, supply_area string, num_reg_circ string, rack string, lb_balance double, "
          "total_theoretical_qty long, qty_for_restock long, qty_per_box long, qty_max_box long")
STATIONS = "supply_area string, takt string"


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def tables(spark, seed):
    """Small tables with repeated rows and NULLs, and parts, areas and stations that meet often."""
    rng = random.Random(seed)
    part = lambda: rng.choice(["P1", "P2", "P3", None])
    area = lambda: rng.choice(["A1", "A2", None])
    demand = [(f"38100{rng.randrange(6):05d}", part(), rng.choice([1.5, None]), 1) for _ in range(15)]
    cycles = [(part(), area(), str(rng.randrange(2)), "r", rng.choice([5.0, None]), 1, 1, 1, 1) for _ in range(8)]
    stations = [(area(), rng.choice(["T1", "T2"])) for _ in range(5)]
    return [spark.createDataFrame(rows, schema)
            for rows, schema in ((demand, DEMAND), (cycles, CYCLES), (stations, STATIONS))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_signed_changes_lead_to_the_new_join(spark, seed):
    (d0, c0, s0), (d1, c1, s1) = tables(spark, seed), tables(spark, seed + 100)
    before = forecast.forecast(d0, c0, s0)
    signed = incremental.forecast_change(d1, incremental.change(d0, d1), (c0, c1), (s0, s1))
    assert bag(incremental.with_change(before, signed)) == bag(forecast.forecast(d1, c1, s1))


def test_nothing_changed_gives_no_change(spark):
    d, c, s = tables(spark, 5)
    signed = incremental.forecast_change(d, incremental.change(d, d), (c, c), (s, s))
    assert signed.count() == 0


class Plant:
    def __init__(self, spark, sf):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="linefeed-forecast-")
        self.store, self.lines = jobs.TableStore(spark, f"{self.root}/tables"), X.fx4pd_file(spark, sf)
        X.write_workbooks(X.pkmc_workbook(spark, sf), f"{self.root}/pkmc.xlsx")
        X.write_workbooks(X.pk05_workbook(spark, sf), f"{self.root}/pk05.xlsx")
        jobs.load_pkmc(self.store, f"{self.root}/pkmc.xlsx", {})
        jobs.load_pk05(self.store, f"{self.root}/pk05.xlsx", {})
        self.n = 0

    def refresh(self, condition):
        self.n += 1
        X.land_csv(self.lines.where(condition), f"{self.root}/{self.n}")
        jobs.refresh_forecast(self.store, f"{self.root}/{self.n}/export.csv", {})
        whole = forecast.forecast(self.store.read("fx4pd"), self.store.read("pkmc"), self.store.read("pk05"))
        assert bag(self.store.read("forecast")) == bag(whole)

    def files(self):
        return {os.path.join(d, f) for d, _, names in os.walk(f"{self.root}/tables/forecast/rows")
                for f in names if f.endswith(".parquet")}


def test_refreshed_forecast_is_the_whole_one(spark, sf_small):
    plant = Plant(spark, sf_small)
    plant.refresh("Kennz <> 'N'")                                         # all bands are built
    plant.refresh("Kennz = 'N'")                                          # new lines, some of them of old keys
    store = plant.store
    pkmc, pk05 = store.read("pkmc"), store.read("pk05")
    store.table("pkmc").commit(pkmc.replace({8: 9}, subset=["qty_max_box"]).where("partnumber <> 'P12'"))
    store.table("pk05").commit(pk05.where("takt <> 'T3'"))
    plant.refresh("Kennz = 'none'")                                       # master data alone changed
    jobs.load_fx4pd(store, f"{plant.root}/1/export.csv", {})              # demand loaded without the forecast
    plant.refresh("Kennz = 'R'")


def test_a_days_cars_touch_their_bands_only(spark, sf_small, monkeypatch):
    monkeypatch.setattr(incremental, "BAND_DIGITS", 2)
    plant = Plant(spark, sf_small)
    plant.refresh("Fahrzeug < '3810001300'")
    before = plant.files()
    plant.refresh("Fahrzeug >= '3810001400'")
    after = plant.files()
    assert before < after and len(after - before) < 6


def test_car_band_is_never_null(spark):
    df = spark.createDataFrame([(None,), ("",), ("12",), ("3810001234",)], "knr_fx4pd string")
    assert [r[0] for r in df.select(incremental.car_band()).collect()] == ["b", "b", "b", "b381000"]


def test_the_stored_forecast_grows_with_the_demand_and_not_with_the_lines_of_its_areas(spark, sf_small):
    plant = Plant(spark, sf_small)
    store, sizes = plant.store, []
    pk05 = store.read("pk05")
    for lines in (pk05, pk05.unionAll(pk05).unionAll(pk05)):
        store.table("pk05").commit(lines)
        plant.refresh("Kennz <> 'N'")
        sizes.append((store.read_folded("forecast").count(), store.read("forecast").count()))
    assert sizes[0][0] == sizes[1][0] and sizes[1][1] == 3 * sizes[0][1] > 0


@pytest.mark.parametrize("seed", [4, 7])
def test_a_change_meets_its_parts_in_one_shuffle(spark, seed):
    (d0, c0, s0), (d1, c1, s1) = tables(spark, seed), tables(spark, seed + 100)
    before = forecast.folded(d0, c0, s0, laid_out=False)
    signed = incremental.folded_change(d1, incremental.change(d0, d1), (c0, c1), (s0, s1))
    part = incremental.car_band()
    rows, signed = (df.localCheckpoint().withColumn("_part", part) for df in (before, signed))
    after = incremental.with_change_by_part(rows, signed, "_part", 3)
    assert bag(forecast.unfolded(after.drop("_part"))) == bag(forecast.forecast(d1, c1, s1))
    assert after._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1
