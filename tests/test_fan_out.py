"""Rows are finished and dealt over all tasks before each makes many."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linefeed import queries as Q
from linefeed.plans import forecast, restock
from tests.test_incremental import bag, tables

DEAL = "RoundRobinPartitioning"


def rows_per_task(df):
    """How many rows each task of the last stage makes."""
    return sorted(r[1] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).collect())


def last_stage(df) -> str:
    """The executed plan above the shuffle that deals the rows out."""
    return df._jdf.queryExecution().executedPlan().toString().split(DEAL)[0]


@pytest.mark.parametrize("seed", [2, 3])
def test_forecast_is_the_plain_join(spark, seed):
    demand, cycles, stations = tables(spark, seed)
    stations = stations.unionAll(stations.limit(3)).unionAll(
        spark.createDataFrame([("A1", None), ("A1", None), (None, "T1")], stations.schema))
    plain = (demand.join(cycles, "partnumber").join(stations, "supply_area")
                   .select(*forecast.FORECAST_COLUMNS))
    found = forecast.forecast(demand, cycles, stations)
    assert bag(found) == bag(plain) and found.schema == plain.schema


def test_forecast_of_one_split_is_made_by_all_tasks(spark):
    demand, cycles, stations = tables(spark, 2)
    demand = demand.crossJoin(spark.range(100)).select(demand.columns).coalesce(1)
    made = rows_per_task(forecast.forecast(demand, cycles, stations))
    assert len(made) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made[-1] < 0.5 * sum(made)


@pytest.mark.parametrize("name", ["forecast_join", "forecast_normalized"])
def test_demand_is_cleaned_before_the_fan_out(spark, sf_small, name):
    plan = last_stage(Q.QUERIES[name](spark, sf_small))
    assert "try_cast(" not in plan and "replace(" not in plan


def test_collated_demand_is_finished_before_the_fan_out(spark, sf_small):
    plan = last_stage(Q.QUERIES["forecast_collated"](spark, sf_small))
    assert "upper(" not in plan and "lower(" not in plan and "try_cast(" not in plan


def test_calls_of_one_split_are_made_by_all_tasks(spark):
    _, cycles, stations = tables(spark, 2)
    due = (cycles.crossJoin(spark.range(100)).select(cycles.columns).coalesce(1)
                 .withColumns({"lb_balance": F.lit(0.0), "qty_for_restock": F.lit(30).cast("long"),
                               "total_theoretical_qty": F.lit(36).cast("long"), "qty_per_box": F.lit(6).cast("long")}))
    stations = stations.unionAll(stations.limit(3)).unionAll(
        spark.createDataFrame([("A1", None), ("A1", None), (None, "T1")], stations.schema))
    plain = restock.restock_candidates(due, stations)
    listed = due.join(stations, "supply_area").select(*restock.RESTOCK_COLUMNS)
    assert bag(plain.select(*restock.RESTOCK_COLUMNS)) == bag(listed)
    calls = restock.kanban_calls(restock.folded_candidates(due, stations))
    assert bag(calls) == bag(restock.kanban_calls(plain)) == bag(
        listed.crossJoin(spark.range(1, 7).toDF("call_no")).select(*restock.CALL_COLUMNS))
    made = rows_per_task(calls)
    assert len(made) == int(spark.conf.get("spark.sql.shuffle.partitions")) and made[-1] < 0.5 * sum(made)


def test_requests_are_worked_out_before_the_fan_out(spark, sf_small):
    for name in ("kanban_calls", "restock_candidates"):
        plan = Q.QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert DEAL in plan and "FLOOR(" not in plan.split(DEAL)[0]
