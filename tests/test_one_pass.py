"""Merges and snapshots are read, grouped and parsed once, whatever their keys hold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import fixtures as X
from linefeed.operators.merge import last_per_key
from linefeed.plans import jobs
from linefeed.plans.buckets import PENDING, BucketedTable, PartedTable
from linefeed.sources.snapshots import read_snapshots


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_last_per_key_reads_its_input_once_and_keeps_rows_without_a_key(spark, tmp_path):
    rows = [("a", 1, "x", 1.0), ("a", 2, "y", None), ("a", 2, "y", 0.5), ("b", None, "z", 1.0),
            (None, 1, "x", 1.0), (None, 1, "x", 1.0), (None, None, None, None), (None, 2, "x", 1.0)]
    spark.createDataFrame(rows, "k string, n int, v string, d double").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    found = last_per_key(df, "k", ["n"])
    assert plan(found).count("Relation [") == 1 and plan(found, "executedPlan").count("Exchange ") == 1
    assert found.columns == df.columns
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, [rows[2], *rows[3:]]))
    whole = last_per_key(df, "k", ["n"], null_safe=True)
    assert sorted(map(repr, (tuple(r) for r in whole.collect()))) == sorted(map(repr, [rows[2], rows[3], rows[7]]))


def test_the_time_in_a_name_is_looked_for_once_per_document(spark, tmp_path):
    named = ("line_20260102T030405.json", "line 2026-01-02_030405_b.json")
    for name in (*named, "line_20269902T030405.json", "x.json"):
        (tmp_path / name).write_text("{}\n")
    docs = read_snapshots(spark, str(tmp_path))
    told = {r["source_file"].rsplit("/", 1)[-1].replace("%20", " "): r["snapshot_ts"] for r in docs.collect()}
    assert {n for n, t in told.items() if t == dt.datetime(2026, 1, 2, 3, 4, 5)} == set(named)
    assert None not in told.values()
    assert plan(docs).count("regexp_") == 1


def test_documents_are_folded_in_one_shuffle(spark, sf_small):
    docs = X.assembly_snapshots(spark, sf_small)
    assert plan(docs, "executedPlan").count("Exchange hashpartitioning") == 1


def test_a_merge_shuffles_old_and_new_rows_once_and_moves_the_written_parts(spark, tmp_path, monkeypatch):
    rows = [(f"k{i}", i, "old") for i in range(200)] + [(None, 1, "old"), (None, 1, "old")]
    table = BucketedTable(spark, f"{tmp_path}/t", "things", ["k"], 8)
    plans, write = [], PartedTable.replace

    def seen(self, touched, rows, *args, **kwargs):
        plans.append(plan(rows, "executedPlan"))
        return write(self, touched, rows, *args, **kwargs)
    monkeypatch.setattr(PartedTable, "replace", seen)
    table.merge(spark.createDataFrame(rows, "k string, n int, v string"), ["n"], null_keys="insert")
    more = [("k5", 9, "new"), ("k5", 8, "no"), ("k6", 1, "late"), (None, 2, "new"), ("x", 1, "new")]
    did = table.merge(spark.createDataFrame(more, "k string, n int, v string"), ["n"], null_keys="insert").first()
    assert (did["rows"], did["inserted"], did["updated"]) == (5, 2, 1)
    want = [r for r in rows if r[0] != "k5"] + [more[0], more[3], more[4]]
    got = [(r["k"], r["n"], r["v"]) for r in table.current().collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 1]


def test_parts_that_were_moved_before_a_crash_stay(spark, tmp_path, monkeypatch):
    part = F.concat(F.lit("b"), F.substring("k", 1, 1))
    table = PartedTable(spark, f"{tmp_path}/t", "bands", part, "first letter")
    table.replace(["b0", "b1"], spark.createDataFrame([("00",), ("10",)], "k string"))
    monkeypatch.setattr(PartedTable, "write_note", lambda self, name, text, w=PartedTable.write_note: (
        None if name == PENDING and not text else w(self, name, text)))     # the note of the change stays
    monkeypatch.setattr(PartedTable, "_delete", lambda self, name: None)
    table.replace(["b0", "b1"], spark.createDataFrame([("01",)], "k string"))
    monkeypatch.undo()
    assert table.read_note(PENDING)
    again = PartedTable(spark, f"{tmp_path}/t", "bands", part, "first letter")
    assert [r["k"] for r in again.current().collect()] == ["01"] and not again.read_note(PENDING)


def test_summed_demand_is_merged_without_a_search_for_repeated_keys(spark, sf_small, tmp_path, monkeypatch):
    def searched(*_, **__):
        raise AssertionError("keys are searched again")
    monkeypatch.setattr("linefeed.plans.jobs.one_per_key", searched)
    monkeypatch.setattr("linefeed.operators.merge.one_per_key", searched)
    lines, store = X.fx4pd_file(spark, sf_small), jobs.TableStore(spark, f"{tmp_path}/tables")
    for n, some in enumerate(("Kennz <> 'N'", "Kennz <> 'R'")):
        X.land_csv(lines.where(some), f"{tmp_path}/{n}")
        jobs.load_fx4pd(store, f"{tmp_path}/{n}/export.csv", {})
    did = store.report("fx4pd").first()
    stored = store.read("fx4pd")
    assert did["inserted"] + did["updated"] == did["given"]
    assert stored.count() == stored.select("knr_fx4pd", "partnumber").distinct().count() == (
        did["given"] + did["unchanged"])
