"""S1-S8 sources and the K6 / versioned-table sink."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

import fixtures as X
from linefeed.plans.sinks import VersionedTable, count_rows, write_observed
from linefeed.sources.excel import iter_sheet_rows, read_excel
from linefeed.sources.loader import load_table, resolve_path, suffix_of
from linefeed.sources.snapshots import read_snapshots


def scratch():
    return tempfile.mkdtemp(prefix="linefeed-test-")


def test_suffix_dispatch(spark):
    assert suffix_of("/a/b/FILE.XLSX") == ".xlsx" and suffix_of("/a/b.csv/") == ".csv"
    with pytest.raises(ValueError):
        load_table(spark, "/tmp/whatever.json")


def test_path_template():
    assert resolve_path("/home/{username}/pkmc.xlsx", {"username": "ana"}) == "/home/ana/pkmc.xlsx"
    with pytest.raises(KeyError):
        resolve_path("/home/{username}/x.csv", {})


def test_csv_ragged_and_bad_bytes(spark):
    d = scratch()
    path = os.path.join(d, "fx.csv")
    with open(path, "wb") as f:
        f.write(b"a,b,c\n1,2,3\n4,5\n6,7,8,9\n\xff,x,y\n")
    got = [tuple(r) for r in load_table(spark, path).collect()]
    assert got[:3] == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]
    assert got[3][0] == "�"


def test_excel_reader_shared_and_inline_strings(spark):
    d = scratch()
    data = X.workbook_bytes(["Material", "Quantidade Kanban", "Posição de armazenamento"],
                            [(" p.1 ", 12, "MAX: 12"), ("P2", None, None)])
    with open(os.path.join(d, "pkmc.xlsx"), "wb") as f:
        f.write(data)
    assert next(iter_sheet_rows(data)) == ["Material", "Quantidade Kanban", "Posição de armazenamento"]
    schema = T.StructType([T.StructField("Material", T.StringType()),
                           T.StructField("Quantidade Kanban", T.LongType()),
                           T.StructField("Posição de armazenamento", T.StringType())])
    got = [tuple(r) for r in read_excel(spark, d, schema).collect()]
    assert got == [(" p.1 ", 12, "MAX: 12"), ("P2", None, None)]
    assert load_table(spark, os.path.join(d, "pkmc.xlsx"), schema).count() == 2


def test_excel_reader_loses_nothing_unnoticed(spark):
    d = scratch()
    with open(os.path.join(d, "a.xlsx"), "wb") as f:
        f.write(X.workbook_bytes(["Material"], [("P1",)]))
    renamed = T.StructType([T.StructField("Material", T.StringType()), T.StructField("absent", T.StringType())])
    with pytest.raises(Exception, match="no column"):
        read_excel(spark, d, renamed).collect()
    with open(os.path.join(d, "b.xls"), "wb") as f:
        f.write(b"legacy")
    with pytest.raises(Exception, match="legacy"):
        read_excel(spark, d, T.StructType(renamed.fields[:1])).collect()
    with pytest.raises(ValueError, match="legacy"):
        load_table(spark, os.path.join(d, "b.xls"))


def test_snapshots_lines_and_whole_files(spark):
    d = scratch()
    doc = {"reception": {"fb": {"s": {"CAR": {"KNR": "1"}, "TACT": "T1"}}}}
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(json.dumps(doc, indent=2))
    whole = read_snapshots(spark, d, whole_file=True)
    assert whole.count() == 1 and json.loads(whole.first()["value"]) == doc
    assert read_snapshots(spark, d).count() > 1  # line mode splits a pretty-printed file


def test_observed_write_and_versions(spark):
    d = scratch()
    df = spark.range(7)
    metrics = write_observed(df, os.path.join(d, "t"), "pkmc")
    assert tuple(metrics.first()) == ("pkmc", 7)
    assert tuple(count_rows(df, "pkmc").first()) == ("pkmc", 7)
    table = VersionedTable(spark, os.path.join(d, "vt"), "pk05")
    assert table.current() is None
    table.commit(spark.range(3), version=1)
    table.commit(spark.range(5), version=1)   # replay of a committed batch: ignored
    assert table.version() == 1 and table.current().count() == 3
    table.commit(table.current().union(spark.range(3, 4)))
    assert table.version() == 2 and table.current().count() == 4


def test_raw_snapshot_pass_through(spark):
    from linefeed.sources.snapshots import raw_snapshots
    d = scratch()
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"lane_1": {}}\n{"reception": {}}\n')
    raw = raw_snapshots(read_snapshots(spark, d))
    assert raw.columns == ["value"]
    assert sorted(r[0] for r in raw.collect()) == ['{"lane_1": {}}', '{"reception": {}}']


def test_spread_only_when_needed(spark, sf_small):
    from linefeed.sources.loader import spread
    one = spark.range(0, 100, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, 64)
    many = spark.range(0, 100, numPartitions=64)
    assert spread(many) is many
    tiny = spark.read.parquet(f"{sf_small}/region.parquet")
    assert spread(tiny) is tiny                     # a few KB: not worth a shuffle


def test_excel_header_schema_and_chunks(spark):
    d = scratch()
    rows = [(f"p{i}", i) for i in range(25)]
    with open(os.path.join(d, "big.xlsx"), "wb") as f:
        f.write(X.workbook_bytes(["Material", "Quantidade Kanban"], rows))
    df = read_excel(spark, d, chunk_rows=10)   # three pandas chunks for one workbook
    assert df.columns == ["Material", "Quantidade Kanban"]
    got = sorted((r[0], r[1]) for r in df.collect())
    assert got == sorted((f"p{i}", str(i)) for i in range(25))


def test_versioned_table_without_pyarrow_client(spark):
    table = VersionedTable(spark, os.path.join(scratch(), "vt"), "pkmc")

    def no_client():
        raise RuntimeError("no pyarrow client for this file system")

    table._fs = no_client   # force the Spark read/write of the pointer
    assert table.version() is None
    table.commit(spark.range(3))
    table.commit(spark.range(5))
    assert table.version() == 1 and table.current().count() == 5


def test_select_sql_over_frames(spark):
    from linefeed.sources.loader import select_sql
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = select_sql(spark, "SELECT v FROM {t} WHERE k > 1", t=df).collect()
    assert [r.v for r in got] == ["b"]


def test_cluster_conf_only_fills_unset_keys(spark):
    from linefeed.session import CLUSTER_CONF, apply_cluster_conf
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF if spark.conf.isModifiable(k)}
    try:
        spark.conf.unset(key)
        apply_cluster_conf(spark)
        assert spark.conf.get(key) == CLUSTER_CONF[key]
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"   # already set: kept
    finally:   # leave the shared test session as it was
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_excel_file_order_index_across_workbooks(spark, sf_small):
    from pyspark.sql import types as T
    from linefeed.plans import cleaning
    from linefeed.schemas import PKMC_HEADERS, PKMC_RAW
    d = scratch()
    X.write_workbooks(X.pkmc_workbook(spark, sf_small, with_key=True), d,
                      rows_per_workbook=60, order_by=["p_partkey"])
    schema = T.StructType([T.StructField(h, f.dataType, True)
                           for h, f in zip(PKMC_HEADERS, PKMC_RAW.fields)])
    raw = read_excel(spark, d, schema, path_col="_file", row_col="_row")
    assert raw.select("_file").distinct().count() >= 3
    clean = cleaning.clean_pkmc(raw, keep=["_file", "_row"])
    ids = cleaning.index_pkmc(clean, order_by=["_file", "_row"])
    got = [r.num_reg_circ for r in ids.orderBy("id").collect()]
    # num_reg_circ is 10 x part key: file order must be ascending part key
    assert [int(x) for x in got] == sorted(int(x) for x in got)


def test_excel_type_inference(spark):
    d = scratch()
    with open(os.path.join(d, "w.xlsx"), "wb") as f:
        f.write(X.workbook_bytes(["part", "qty", "ratio", "note"],
                                 [("p1", 3, 1.5, "x"), ("p2", 4, 2, None), ("p3", None, 0.25, "7")]))
    inferred = read_excel(spark, d, infer_rows=10000)
    assert [f.dataType.simpleString() for f in inferred.schema.fields] == \
        ["string", "bigint", "double", "string"]
    assert sorted(tuple(r) for r in inferred.collect())[0] == ("p1", 3, 1.5, "x")
    assert all(f.dataType.simpleString() == "string" for f in read_excel(spark, d).schema.fields)


def test_ragged_and_unparsable_demand_lines_are_judged(spark, tmp_path):
    from linefeed.plans import cleaning, jobs
    header = "Fahrzeug,Sachnummer,Lieferant,Position,Kennz,Menge,Einheit"
    lines = ["381 1,P1,s,1,N, 1.5,2", "3812,P1,s,1,N", "3813,P2,s,1,N,2.5,3,more,more", "3814,P2,s,1,N,abc,3",
             "3815,P2,s,1,N,,3", "3816,P2", "3817,P3,s,1,N,nan,x", '3818,"P4, x",s,1,N,4,1']
    (tmp_path / "export.csv").write_text("\n".join([header, *lines]) + "\n")
    store = jobs.TableStore(spark, str(tmp_path / "tables"))
    result = {r["table_name"]: r["rows"] for r in jobs.load_fx4pd_judged(
        store, str(tmp_path / "export.csv"), {}).collect()}
    assert result == {"fx4pd": 4, "fx4pd_rejects": 4}
    reasons = {r["knr_fx4pd"]: r["reason"] for r in store.read("fx4pd_rejects").collect()}
    assert reasons == {"3812": cleaning.CUT_SHORT, "3816": cleaning.CUT_SHORT, "3814": cleaning.NOT_A_NUMBER,
                       "3815": cleaning.NO_USAGE}
    done = store.done["fx4pd"]
    assert (done[cleaning.CUT_SHORT], done[cleaning.NO_USAGE], done[cleaning.NOT_A_NUMBER]) == (2, 1, 1)
    plain = jobs.TableStore(spark, str(tmp_path / "plain"))
    jobs.load_fx4pd(plain, str(tmp_path / "export.csv"), {})
    assert sorted(map(str, plain.read("fx4pd").collect())) == sorted(map(str, store.read("fx4pd").collect()))
