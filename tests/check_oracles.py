"""Compare registered queries with their SQL counterparts: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries
from shopflow.session import session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def compare(spark, con, name, sf_dir):
    started = time.time()
    df = queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect())
    took = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)}", took
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = [names.index(c) for c in sorted(names)]
    want = sorted(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    if cols != sorted(names):
        return f"COLUMNS {cols} {sorted(names)}", took
    if got == want:
        return f"ok {len(got)}", took
    only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"DIFF spark={len(got)} sql={len(want)}\n   spark only {only_got}\n   sql only   {only_want}", took


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or list(queries())
    spark = session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
                                   "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in names:
        try:
            result, took = compare(spark, con, name, sf_dir)
        except Exception as e:
            result, took = "ERROR " + str(e).split("JVM stacktrace")[0][:700], 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{name:28s} {took:6.2f}s {result}", flush=True)


if __name__ == "__main__":
    main()
