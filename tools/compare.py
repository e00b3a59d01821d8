"""Run registered queries and compare them with their SQL: python tools/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master(f"local[{cores}]").appName("rostrum").config("spark.sql.shuffle.partitions", cores)
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


def database(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    return repr(v) if not hasattr(v, "item") else _plain(v.item())


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf, queries, oracles):
    """(status, rows, seconds, detail)"""
    t0 = time.time()
    df = queries[name](spark, sf)
    cols, rows = df.columns, df.collect()
    took = time.time() - t0
    if name not in oracles:
        return "rows-only", len(rows), took, ""
    t0 = time.time()
    cur = con.execute(oracles[name])
    want_cols = [d[0] for d in cur.description]
    want = canonical(want_cols, cur.fetchall())
    got = canonical(cols, [tuple(x) for x in rows])
    sql_took = f"sql {time.time() - t0:.1f}s "
    if got == want:
        return "ok", len(rows), took, sql_took
    if got[0] != want[0]:
        return "MISMATCH", len(rows), took, f"columns {got[0]} vs {want[0]}"
    a, b = set(got[1]), set(want[1])
    return "MISMATCH", len(rows), took, f"{len(got[1])} vs {len(want[1])} rows; only here {list(a - b)[:3]}; only SQL {list(b - a)[:3]}"


if __name__ == "__main__":
    from catalog import ORACLES, QUERIES

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), database(sf)
    bad = 0
    for name in names or QUERIES:
        try:
            status, n, took, detail = compare(spark, con, name, sf, QUERIES, ORACLES)
        except Exception as e:  # report and go on with the next query
            status, n, took, detail = "ERROR", 0, 0.0, f"{type(e).__name__}: {str(e)[:600]}"
        bad += status in ("ERROR", "MISMATCH")
        print(f"{status:10s} {name:24s} {n:8d} rows {took:6.1f}s {detail[:900]}", flush=True)
    print("failed:", bad)
