"""Run registered queries against their DuckDB oracle: python -m tests.run_oracle [names...]"""

from __future__ import annotations

import sys
import time

from linefeed.session import build_session
from tests.harness import compare, duck_connection


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    import os

    import __spark_entry__ as E
    spark = build_session()
    if os.environ.get("LINEFEED_NO_BROADCAST"):
        # exercise every shuffle fallback: no dimension passes the size check and
        # Spark's own planner may not broadcast either
        spark.conf.set("spark.linefeed.broadcast.maxRows", "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con = duck_connection(sf_dir)
    queries, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(queries):
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in oracle:
                print(f"{name:26s} ROWS {df.count():>8} (no oracle) {time.time() - t:.1f}s")
                continue
            r = compare(df, con, oracle[name])
            ok = r["schema_match"] and r["rows_match"] and r["hash_match"]
            bad += not ok
            print(f"{name:26s} {'OK ' if ok else 'BAD'} {r['rows_spark']:>8} {r['rows_oracle']:>8} "
                  f"schema={r['schema_match']} hash={r['hash_match']} {time.time() - t:.1f}s")
            if not r["schema_match"]:
                print("    spark :", r["names_spark"], "\n    oracle:", r["names_oracle"])
        except Exception as e:  # report and continue with the next query
            bad += 1
            print(f"{name:26s} ERROR {type(e).__name__}: {str(e)[:500]}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
