"""Consumption works from the parts fed at each station; the forecast, which grows with the square of the tables, is not made."""

from __future__ import annotations

import pytest

from linefeed import queries as Q
from linefeed.oracle import ORACLE
from linefeed.plans import consumption, forecast
from tests.harness import compare, duck_connection
from tests.test_incremental import bag, tables

LINE = "knr_fx4pd string, takt string"
WITHOUT_FORECAST = ["consume_rows", "consume_apply_last", "consume_apply_sum", "consume_rows_colocated",
                    "consume_once_stream", "consume_once_moves", "store_consume", "write_result"]


def line(spark):
    """Every car at two stations, one of them twice, and some at none."""
    cars = [(f"38100{i:05d}", t) for i in range(6) for t in ("T1", "T2", "T2")]
    return spark.createDataFrame([*cars, ("3810000003", None), ("3810000009", "T2")], LINE)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_at_their_stations_are_the_forecasts(spark, seed):
    demand, cycles, stations = tables(spark, seed)
    made, fed = forecast.forecast(demand, cycles, stations), forecast.fed_parts(cycles, stations)
    want = consumption.consumption_rows(made, line(spark), cycles)
    found = consumption.new_balances(consumption.present_lines(demand, line(spark), fed), cycles)
    assert bag(found) == bag(want) and found.count()
    assert bag(consumption.fed_usage(fed, line(spark), demand)) == bag(
        consumption.station_usage(made, line(spark), demand))


@pytest.mark.parametrize("name", WITHOUT_FORECAST)
def test_query_makes_no_forecast(spark, sf_small, monkeypatch, name):
    def no_forecast(*_, **__):
        raise AssertionError("the forecast is made")
    monkeypatch.setattr(forecast, "forecast", no_forecast)
    r = compare(Q.QUERIES[name](spark, sf_small), duck_connection(sf_small), ORACLE[name])
    assert r["schema_match"] and r["rows_match"] and r["hash_match"], r
    for table in spark.catalog.listTables():
        if table.name.startswith("stored_"):
            spark.sql(f"DROP TABLE {table.name}")


@pytest.mark.parametrize("seed", [2, 3])
@pytest.mark.parametrize("limit", [1, 4, 50])
def test_preview_takes_the_first_rows_of_few_demand_rows(spark, monkeypatch, seed, limit):
    demand, cycles, stations = tables(spark, seed)
    demand = demand.unionAll(demand.limit(5))
    want = forecast.preview_sorted(forecast.forecast(demand, cycles, stations), forecast.FORECAST_COLUMNS, limit)
    made, seen = forecast.forecast, []
    monkeypatch.setattr(forecast, "forecast", lambda fx4pd, *tables: seen.append(fx4pd.count()) or made(fx4pd, *tables))
    found = forecast.preview_forecast(demand, cycles, stations, limit)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()]
    assert seen and seen[0] <= limit


@pytest.mark.parametrize("seed", [2, 3])
def test_folded_forecast_is_the_forecast(spark, seed):
    demand, cycles, stations = tables(spark, seed)
    stations = stations.unionAll(spark.createDataFrame([("A1", None)], stations.schema))
    made, kept = forecast.forecast(demand, cycles, stations), forecast.folded(demand, cycles, stations)
    assert bag(forecast.unfolded(kept)) == bag(made)
    assert kept.agg(forecast.copies_of(kept)).first()[0] == made.count() > kept.count()
    assert bag(consumption.consumption_rows(kept, line(spark), cycles)) == bag(
        consumption.consumption_rows(made, line(spark), cycles))
    assert bag(consumption.station_usage(kept, line(spark), demand)) == bag(
        consumption.station_usage(made, line(spark), demand))
