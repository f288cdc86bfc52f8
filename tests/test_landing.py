"""Stand-in exports are written line by line: no task puts a file together in memory."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as X


def test_ragged_lines_are_written_as_they_come(spark, tmp_path, monkeypatch):
    def gathered(*_):
        raise AssertionError("lines are gathered")
    monkeypatch.setattr(F, "collect_list", gathered)
    df = spark.createDataFrame([(" a", "b ", "1"), ("c", None, "2"), ("#", "\\e", "3")], "x string, y string, n string")
    path = X.land_ragged_csv(df, str(tmp_path), F.col("n").cast("int"))
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert set(lines) == {"x,y,n", " a", "c,", "#,\\e,3"}
    read = spark.read.option("header", True).csv(path)
    assert read.columns == ["x", "y", "n"] and read.count() == 3
