"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate.

Row count, column names (sorted) and an order-insensitive hash of the
values are compared; floats are rounded so summation order cannot
change the hash.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return names, len(rows), h


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s = digest(spark_df.columns, s_rows)
    rel = con.sql(sql)
    d = digest(rel.columns, rel.fetchall())
    return {"rows_spark": s[1], "rows_oracle": d[1], "schema_match": s[0] == d[0],
            "names_spark": s[0], "names_oracle": d[0],
            "rows_match": s[1] == d[1], "hash_match": s[2] == d[2]}
