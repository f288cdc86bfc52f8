"""Keys of a small side reach a stored per-car table: as a list with bloom filters, or as a range."""

from __future__ import annotations

import pytest

from linefeed.operators import joins
from linefeed.plans import forecast
from linefeed.plans.consumption import present_demand
from tests.test_pipelines import plan_text

SCHEMA = "knr_fx4pd string, takt string, partnumber string, qty_usage double"
CARS = 4000


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Demand of every second car, in row groups of few rows, so that cars in between are in no group."""
    rows = [(f"381{i:07d}", f"T{p}", f"P{p}", 1.0) for i in range(0, CARS, 2) for p in range(5)]
    path = str(tmp_path_factory.mktemp("forecast") / "table")
    demand = spark.createDataFrame(rows, SCHEMA)
    (forecast.by_car(demand, 4).write.options(**forecast.CAR_FILTER)
     .option("parquet.block.size", 16_384).option("parquet.block.size.row.check.min", 100).parquet(path))
    return spark.read.parquet(path)


def read_rows(df) -> int:
    """Rows that the table's scan gave out when the plan ran."""
    df._jdf.queryExecution().executedPlan()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in text or "Scan parquet" in text
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    todo, best = [leaves.apply(i) for i in range(leaves.size())], 0
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            inner = node.plan().collectLeaves()
            todo += [inner.apply(i) for i in range(inner.size())]
        elif "knr_fx4pd" in node.toString() and "takt" in node.toString() and "Scan" in node.nodeName() \
                and "partnumber" in node.toString():
            best = max(best, node.metrics().apply("numOutputRows").value())
    return best


def cars(spark, numbers, takt="T3"):
    return spark.createDataFrame([(f"381{i:07d}", takt) for i in numbers], "knr_fx4pd string, takt string")


def test_scattered_cars_are_listed(spark, stored):
    few = cars(spark, [10, 1998, 3990])
    found = present_demand(stored, few)
    assert sorted(r["knr_fx4pd"] for r in found.collect()) == ["3810000010", "3810001998", "3810003990"]
    assert "In(knr_fx4pd, [381" in plan_text(stored.where(joins.key_range(few, ["knr_fx4pd"])))


def test_cars_that_are_not_in_the_table_read_nothing(spark, stored):
    """Odd cars lie inside every row group's range; only the bloom filters tell that they are not there."""
    missing = cars(spark, range(1, CARS, 98))
    assert read_rows(stored.where(joins.key_range(missing, ["knr_fx4pd"]))) < 0.2 * stored.count()
    assert read_rows(stored.where(joins.key_range(missing, ["knr_fx4pd"], probed=5))) > 0.9 * stored.count()


def test_many_keys_become_a_range(spark, stored):
    few = cars(spark, range(100, 200))
    plan = plan_text(stored.where(joins.key_range(few, ["knr_fx4pd"], probed=50)))
    assert "GreaterThanOrEqual(knr_fx4pd" in plan and "LessThanOrEqual(knr_fx4pd" in plan
    none = stored.where(joins.key_range(few.where("false"), ["knr_fx4pd"]))
    assert none.count() == 0
