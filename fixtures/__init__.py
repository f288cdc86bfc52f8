"""Stand-in inputs derived from the driver's test tables.

The test tables hold no line-feeding data, so these views only reshape
them into the raw schemas the jobs expect (workbook exports, per-car
demand files, assembly snapshots).  They do none of the jobs' work: the
cleaning, joining and merging all run in ``linefeed.plans`` on top.

The SQL text is valid in both Spark SQL and DuckDB.  Spark runs it with
``spark.sql(text, part=<DataFrame>)``; the DuckDB oracle substitutes the
plain table names (``{part}`` -> ``part``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.workbooks import workbook_bytes, write_workbooks  # noqa: F401
from linefeed.schemas import FX4PD_POSITIONS, PK05_HEADERS, PKMC_HEADERS
from linefeed.sources.loader import spread

PKMC_RAW_SQL = """
SELECT CASE p_partkey % 4 WHEN 0 THEN 'p.' || CAST(p_partkey AS STRING)
                          WHEN 1 THEN ' P ' || CAST(p_partkey AS STRING) || ' '
                          WHEN 2 THEN 'p#' || CAST(p_partkey AS STRING)
                          ELSE 'P' || CAST(p_partkey AS STRING) END AS partnumber,
       CASE WHEN p_partkey % 11 = 0 THEN 'SEM AREA'
            ELSE 'LB P' || CAST(p_partkey % 50 + 1 AS STRING) || 'A' END AS supply_area,
       CAST(p_partkey * 10 AS STRING) AS num_reg_circ,
       CASE WHEN p_partkey % 6 = 0 THEN 'B02' ELSE 'B01' END AS deposit_type,
       p_type AS deposit_position, p_brand AS container, p_name AS description,
       'N' || CAST(p_size AS STRING) AS pack_standard,
       CASE WHEN p_partkey % 40 = 1 THEN CAST(0 AS BIGINT) ELSE CAST(p_size AS BIGINT) END AS qty_per_box,
       CASE p_partkey % 5 WHEN 0 THEN 'MAX: 12' WHEN 1 THEN 'max 5' WHEN 2 THEN '8'
                          WHEN 3 THEN 'n/a' END AS qty_max_box,
       p_partkey
FROM {part}
"""

PK05_RAW_SQL = """
SELECT 'LB P' || CAST(s_suppkey % 50 + 1 AS STRING) || 'A' AS supply_area,
       CASE WHEN s_suppkey % 5 = 0 THEN 'LB02' ELSE 'LB01' END AS deposit,
       s_name AS responsible, 'DP' || CAST(s_nationkey AS STRING) AS discharge_point,
       CASE WHEN s_suppkey % 4 = 3 THEN 'sem takt'
            ELSE 'LINHA T' || CAST(s_nationkey AS STRING) || ' X' END AS description,
       s_suppkey
FROM {supplier}
"""

# Columns 0, 1, 5 and 6 are the ones the job keeps; 2-4 are carried filler.
FX4PD_RAW_SQL = """
SELECT '38' || '1' || lpad(CAST(l_orderkey AS STRING), 7, '0') AS knr_fx4pd,
       CASE WHEN l_linenumber = 3 THEN ' p.' ELSE ' P' END || CAST(l_partkey AS STRING) AS partnumber,
       CAST(l_suppkey AS STRING) AS supplier,
       CAST(l_linenumber AS STRING) AS line,
       l_returnflag AS flag,
       CASE WHEN l_linenumber = 7 THEN 'abc'
            ELSE ' ' || CAST(CAST(l_quantity AS INT) AS STRING) || '.5' END AS qty_usage,
       CASE WHEN l_linenumber % 2 = 0 THEN 'ST' ELSE CAST(l_linenumber AS STRING) END AS qty_unit
FROM {lineitem}
"""

# Expected vehicle positions; Spark folds these into snapshot JSON documents
# (linefeed.plans.assembly.snapshot_documents) and the job parses them back.
ASSEMBLY_FLAT_SQL = """
SELECT lpad(CAST(o_orderkey AS STRING), 7, '0') AS knr, o_orderpriority AS model,
       o_orderkey AS lfdnr_sequence, '38' AS werk, '1' AS spj,
       CASE WHEN o_custkey % 6 = 5 THEN 'reception'
            ELSE 'lane_' || CAST(o_custkey % 6 AS STRING) END AS lane,
       'T' || CAST(o_custkey % 25 AS STRING) AS takt,
       o_orderkey AS slot_no
FROM {orders}
"""

# A later poll of the cars whose order is finished: each is one station further on.
ASSEMBLY_MOVED_SQL = """
SELECT lpad(CAST(o_orderkey AS STRING), 7, '0') AS knr, o_orderpriority AS model,
       o_orderkey AS lfdnr_sequence, '38' AS werk, '1' AS spj,
       'lane_' || CAST(o_custkey % 5 AS STRING) AS lane,
       'T' || CAST((o_custkey + 1) % 25 AS STRING) AS takt,
       o_orderkey AS slot_no
FROM {orders} WHERE o_orderstatus = 'F'
"""

# Current line-side stock per control cycle (lives only in the stored table).
STOCK_SQL = """
SELECT 'P' || CAST(p_partkey AS STRING) AS partnumber,
       CASE WHEN p_partkey % 11 = 0 THEN 'SEM AREA'
            ELSE 'LB P' || CAST(p_partkey % 50 + 1 AS STRING) || 'A' END AS supply_area,
       CAST(CASE WHEN p_partkey % 40 = 1 THEN -5 ELSE (p_partkey * 37) % 200 END AS DOUBLE) AS lb_balance
FROM {part}
"""

# Landed documents that are no snapshots: an array, a text cut off, a number.
BAD_DOCS_SQL = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '[' || CAST(o_orderkey AS STRING) || ']'
                            WHEN '2-HIGH' THEN '{{"lane_1": {{"fb1": ' || CAST(o_orderkey AS STRING)
                            ELSE CAST(o_orderkey AS STRING) END AS value
FROM {orders} WHERE o_orderstatus = 'P'
"""

# Transfer orders for the open-order selection.
TRANSFER_ORDERS_SQL = """
SELECT CAST(o_orderkey AS STRING) AS order_no,
       CASE WHEN o_custkey % 3 = 0 THEN 'BRK' ELSE 'ANC' END AS warehouse,
       CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'B01'
            ELSE 'B02' END AS storage_type,
       o_orderstatus = 'O' AS is_open,
       CAST(o_orderdate AS DATE) AS created
FROM {orders}
"""

FIXTURE_SQL = {
    "pkmc_raw": (PKMC_RAW_SQL, ("part",)),
    "pk05_raw": (PK05_RAW_SQL, ("supplier",)),
    "fx4pd_raw": (FX4PD_RAW_SQL, ("lineitem",)),
    "assembly_flat": (ASSEMBLY_FLAT_SQL, ("orders",)),
    "assembly_moved": (ASSEMBLY_MOVED_SQL, ("orders",)),
    "bad_docs": (BAD_DOCS_SQL, ("orders",)),
    "stock": (STOCK_SQL, ("part",)),
    "transfer_orders": (TRANSFER_ORDERS_SQL, ("orders",)),
}


def read_table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    """One driver table (``sf_dir`` may be a str or a path object)."""
    return spread(spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet"))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run one fixture view in Spark over the parquet tables of ``sf_dir``."""
    text, tables = FIXTURE_SQL[name]
    frames = {t: read_table(spark, sf_dir, t) for t in tables}
    return spark.sql(text, **frames)


def duck(name: str) -> str:
    """The same fixture text for DuckDB (plain table names)."""
    text, tables = FIXTURE_SQL[name]
    return text.format(**{t: t for t in tables})


def pkmc_workbook(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """PKMC export with its original (Portuguese) headers.

    ``with_key`` also returns ``p_partkey``, the line order of the export
    when it is landed with ``write_workbooks(..., order_by=["p_partkey"])``.
    """
    raw = fixture(spark, sf_dir, "pkmc_raw")
    back = {v: k for k, v in PKMC_HEADERS.items()}
    return raw.select([F.col(c).alias(back[c]) for c in raw.columns if c in back]
                      + ([F.col("p_partkey")] if with_key else []))


def pk05_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PK05 export with its original headers."""
    raw = fixture(spark, sf_dir, "pk05_raw")
    back = {v: k for k, v in PK05_HEADERS.items()}
    return raw.select([F.col(c).alias(back[c]) for c in raw.columns if c in back])


def fx4pd_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4PD export: seven columns, headers irrelevant (taken by position)."""
    raw = fixture(spark, sf_dir, "fx4pd_raw")
    assert {raw.columns[i] for i in FX4PD_POSITIONS} == set(FX4PD_POSITIONS.values())
    return raw.toDF("Fahrzeug", "Sachnummer", "Lieferant", "Position", "Kennz", "Menge", "Einheit")


CARS_PER_SNAPSHOT = 256


def _json_object(entries: F.Column) -> F.Column:
    """``{k1: v1, ...}`` text from an array of ``'"k":<json>'`` fragments."""
    return F.concat(F.lit("{"), F.array_join(F.array_sort(entries), ","), F.lit("}"))


def assembly_snapshots(spark: SparkSession, sf_dir: str,
                       cars_per_snapshot: int = CARS_PER_SNAPSHOT, positions: str = "assembly_flat") -> DataFrame:
    """Assembly-line snapshot documents (one JSON text per row, column ``value``).

    The positions of a fixture are folded into documents of at most
    ``cars_per_snapshot`` cars: ``{lane: {fb: {slot: {CAR, LANE, TACT}}}}``.
    Line slots carry ``LANE``; reception slots leave it out.  Every feeder
    also holds one slot with an empty ``CAR``, and every document a
    non-lane ``meta`` key, as in the documented snapshot shape
    (FIXTURES.md §1.4).
    """
    flat = fixture(spark, sf_dir, positions)
    car = F.to_json(F.struct(F.col("knr").alias("KNR"), F.col("model").alias("MODELL"),
                             F.col("lfdnr_sequence").alias("LFDNR"),
                             F.col("werk").alias("WERK"), F.col("spj").alias("SPJ")))
    with_lane = F.to_json(F.struct(F.lit(0).alias("CAR"), F.col("lane").alias("LANE"),
                                   F.col("takt").alias("TACT")))
    without_lane = F.to_json(F.struct(F.lit(0).alias("CAR"), F.col("takt").alias("TACT")))
    slot = F.when(F.col("lane") == "reception", without_lane).otherwise(with_lane)
    slot = F.regexp_replace(slot, '^\\{"CAR":0', "")
    slots = flat.select(
        (F.col("slot_no") / F.lit(cars_per_snapshot)).cast("bigint").alias("doc_id"),
        F.col("lane"), F.lit("fb1").alias("fb"),
        F.concat(F.lit('"s'), F.col("slot_no").cast("string"), F.lit('":{"CAR":'), car,
                 slot).alias("entry")).repartition("doc_id")  # the three folds below need no other shuffle
    empty = F.lit('"s_empty":{"CAR":{}}')
    fbs = (slots.groupBy("doc_id", "lane", "fb")
                .agg(_json_object(F.array_append(F.collect_list("entry"), empty)).alias("fb_json")))
    lanes = (fbs.groupBy("doc_id", "lane")
                .agg(_json_object(F.collect_list(
                    F.concat(F.lit('"'), F.col("fb"), F.lit('":'), F.col("fb_json")))).alias("lane_json")))
    docs = (lanes.groupBy("doc_id")
                 .agg(_json_object(F.array_append(
                     F.collect_list(F.concat(F.lit('"'), F.col("lane"), F.lit('":'), F.col("lane_json"))),
                     F.concat(F.lit('"meta":'), F.col("doc_id").cast("string")))).alias("value")))
    return docs


# --- landed files ------------------------------------------------------------

def land_csv(df: DataFrame, folder: str) -> str:
    """Land ``df`` as a header CSV export; returns the ``.csv`` path to read."""
    path = folder.rstrip("/") + "/export.csv"
    (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).mode("overwrite").csv(path))
    return path


def land_ragged_csv(df: DataFrame, folder: str, fields: F.Column) -> str:
    """Land ``df`` as a CSV export whose lines have so many fields: cut short, or with more at the end.

    Values hold no commas, tabs or quotes.  Each task writes its lines one
    after another: a line is the one column of a tab-separated file whose
    header is the export's.
    """
    path = folder.rstrip("/") + "/export.csv"
    values = F.concat(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]),
                      F.array_repeat(F.lit("more"), 9))
    lines = df.select(F.array_join(F.slice(values, F.lit(1), fields), ",").alias(",".join(df.columns)))
    (lines.write.option("header", True).option("sep", "\t").option("quote", "")
          .option("escape", "").option("comment", "\u0001").option("ignoreLeadingWhiteSpace", False)
          .option("ignoreTrailingWhiteSpace", False).mode("overwrite").csv(path))
    return path


def land_snapshots(docs: DataFrame, folder: str, files: int = 4, polled: str | None = None) -> str:
    """Land snapshot documents as text files, one document per line.

    ``polled`` (``20260101T050000``) is the time of the poll that the files'
    names then carry; without it only their modification time tells it.
    """
    target = f"{folder.rstrip('/')}/.landing" if polled else folder
    docs.select("value").repartition(files).write.mode("overwrite").text(target)
    if polled:
        jvm, conf = docs.sparkSession._jvm, docs.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(conf)
        parts = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]
        for i, part in enumerate(parts):
            fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/line{i}_{polled}.json"))
        fs.delete(path, True)
    return folder
