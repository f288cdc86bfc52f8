"""Tables in parts: only touched parts are rewritten, an interrupted change is finished, folds expire their batches."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from linefeed.plans.buckets import PENDING, BucketedTable, PartedTable
from linefeed.plans.sinks import Batches
from linefeed.streaming.ingest import CHANGES, compact, with_changes

SCHEMA = "k string, n long, v string"


def made(spark, buckets=100):
    root = tempfile.mkdtemp(prefix="linefeed-buckets-")
    table = BucketedTable(spark, root, "things", ["k", "n"], buckets)
    rows = [(f"k{i}", i, "old") for i in range(2000)] + [(None, 1, "old"), ("k", None, "old"), (None, None, "old")]
    report = table.merge(spark.createDataFrame(rows, SCHEMA)).first()
    assert (report["rows"], report["inserted"], report["updated"]) == (2003, 2003, 0)
    return table, dict(((k, n), v) for k, n, v in rows)


def files(table):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for d, _, names in os.walk(f"{table.root}/rows") for f in names if f.endswith(".parquet")}


def content(table):
    rows = table.current().collect()
    assert len({(r["k"], r["n"]) for r in rows}) == len(rows)
    return {(r["k"], r["n"]): r["v"] for r in rows}


def test_a_merge_rewrites_the_touched_buckets_only(spark):
    table, want = made(spark)
    before = files(table)
    report = table.merge(spark.createDataFrame([("k7", 7, "new")], SCHEMA)).first()
    want["k7", 7] = "new"
    assert content(table) == want
    assert (report["rows"], report["inserted"], report["updated"], report["buckets"]) == (1, 0, 1, 1)
    after = files(table)
    written, kept = set(after) - set(before), set(after) & set(before)
    assert len(written) == 1 and len(kept) == len(before) - 1
    assert sum(os.path.getsize(f) for f in written) < 0.05 * sum(os.path.getsize(f) for f in after)


def test_null_keys_stay_one_row(spark):
    table, want = made(spark)
    again = spark.createDataFrame([(None, 1, "a"), ("k", None, "b"), (None, None, "c"), ("k", 5, "d")], SCHEMA)
    for _ in range(2):
        table.merge(again)
    want |= {(None, 1): "a", ("k", None): "b", (None, None): "c", ("k", 5): "d"}
    assert content(table) == want


def test_the_last_row_of_a_key_wins_and_empty_loads_change_nothing(spark):
    table, want = made(spark)
    table.merge(spark.createDataFrame([("k1", 1, "b"), ("k1", 1, "c"), ("k1", 1, "a")], SCHEMA))
    want["k1", 1] = "c"
    assert table.merge(spark.createDataFrame([], SCHEMA)).first()["buckets"] == 0
    assert content(table) == want


def test_an_interrupted_change_is_finished_by_the_next_reader(spark, monkeypatch):
    table, want = made(spark)
    monkeypatch.setattr(BucketedTable, "_finish", lambda self: None)
    monkeypatch.setattr(BucketedTable, "_delete", lambda self, name: None)
    table.merge(spark.createDataFrame([("k9", 9, "late")], SCHEMA))      # dies before the parts are replaced
    monkeypatch.undo()
    want["k9", 9] = "late"
    assert table.read_note(PENDING)
    opened = BucketedTable(spark, table.root, "things", ["k", "n"], 100)
    assert content(opened) == want and not opened.read_note(PENDING)


def test_another_layout_is_refused(spark):
    table, _ = made(spark, 4)
    with pytest.raises(ValueError):
        BucketedTable(spark, table.root, "things", ["k", "n"], 8)
    with pytest.raises(TypeError):
        table.commit(table.current())


def test_parts_without_rows_go(spark):
    root = tempfile.mkdtemp(prefix="linefeed-parts-")
    table = PartedTable(spark, root, "bands", F.concat(F.lit("b"), F.substring("k", 1, 1)), "first letter")
    table.replace(["b0", "b1"], spark.createDataFrame([("00",), ("01",), ("10",)], "k string"))
    assert sorted(r["k"] for r in table.current().collect()) == ["00", "01", "10"]
    table.replace(["b0", "b2"], spark.createDataFrame([("20",)], "k string"))
    assert sorted(r["k"] for r in table.current().collect()) == ["10", "20"]
    assert sorted(n for n in os.listdir(f"{root}/rows") if n.startswith("_part")) == ["_part=b1", "_part=b2"]
    assert not [n for n in os.listdir(root) if n.startswith("_staged")]
    table.replace(["b1", "b2"], spark.createDataFrame([], "k string"))
    assert table.current().count() == 0


def test_a_fold_writes_the_buckets_of_its_batches_and_removes_them(spark):
    table, want = made(spark)
    empty = spark.createDataFrame([], SCHEMA)
    log = Batches(table, CHANGES)
    log.append(spark.createDataFrame([("k3", 3, "x"), ("k4", 4, "x")], SCHEMA), 0)
    log.append(spark.createDataFrame([("k3", 3, "y")], SCHEMA), 1)
    want |= {("k3", 3): "y", ("k4", 4): "x"}
    shown = {(r["k"], r["n"]): r["v"] for r in with_changes(table, ["k", "n"], ["v"], empty).collect()}
    assert shown == want
    before = files(table)
    report = compact(table, ["k", "n"], ["v"], empty).first()
    assert report["buckets"] <= 2 and content(table) == want and table.folded() == 1
    assert len(set(files(table)) - set(before)) == report["buckets"]
    assert os.listdir(f"{table.root}/{CHANGES}") == []
    assert compact(table, ["k", "n"], ["v"], empty).first()["buckets"] == 0
