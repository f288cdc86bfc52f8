"""Operator 13: every order of the filters against SQL and against a brute-force version."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefeed.llm import filter_audit
from linefeed.llm.queries import op13_filter_audit
from tests.harness import compare, duck_connection

LABELS = "doc_id long, quality int, toxic int"


def got(spark, docs, labels):
    frame = spark.createDataFrame(labels, LABELS)
    return sorted(tuple(r) for r in filter_audit.filter_audit(docs, frame).collect())


def test_against_duckdb(spark, sf_small):
    found = compare(op13_filter_audit(spark, sf_small), duck_connection(sf_small), filter_audit.ORACLE)
    assert found["hash_match"] and found["schema_match"] and found["rows_spark"] % 600 == 0


def test_edge_rows_and_clashing_columns(spark, edge):
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (None, 1, 1), (3, None, None), (99, 1, 1)]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in edge.select("doc_id", "text", "source").collect()]
    docs = edge.withColumns({c: F.lit(c) for c in ("part", "mask", "salt", "salts", "one", "good", "m", "bit")})
    assert got(spark, docs, labels) == sorted(filter_audit.brute_force(rows, labels))


def test_many_copies_over_sources_and_salts(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, words if i % 3 else f"{words} {i} {'# ' * (i % 2)}", "left" if i % 7 else None) for i in range(300)]
    rows += [(i, "TOO SHORT", "right") for i in range(290, 310)] + [(5, words, "left"), (5, words, "left")]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 300, 4)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want = sorted(filter_audit.brute_force(rows, labels))
    assert got(spark, docs, labels) == want
    # the common text is dealt over many salts, and still every copy but the first is found
    e = [r for r in want if r[1] == "EABCD" and r[2] == 1]
    assert sum(r[4] for r in e) == 220


def test_shuffle_path_gives_the_same(spark, edge):
    labels = [(1, 1, 0), (2, 1, 1)]
    small = got(spark, edge, labels)
    spark.conf.set("spark.linefeed.broadcast.maxRows", "0")
    try:
        assert got(spark, edge, labels) == small
    finally:
        spark.conf.unset("spark.linefeed.broadcast.maxRows")


def test_equal_hashes_are_not_equal_texts(spark):
    rows = spark.createDataFrame([(1, "a", "one", 7), (2, "a", "two", 7), (3, "b", "two", 7), (3, "a", "two", 7)],
                                 "doc_id long, part string, text string, h long")
    found = filter_audit.duplicates(rows, rows.drop("text"))
    assert sorted(tuple(r) for r in found.collect()) == [(3, "a", 7), (3, "b", 7)]


def test_plan_has_no_python(spark, sf_small):
    plan = op13_filter_audit(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_no_rows(spark, empty):
    assert got(spark, empty, []) == []
