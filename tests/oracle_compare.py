"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Mirrors the driver's correctness gate: row count, column names (sorted) and
an order-insensitive comparison of normalised values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<NULL>"
        return f"{v:.6g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return str(v)


def _rows_spark(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def _rows_duck(rel):
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark, name: str, sf_dir: str, con=None, show: int = 5) -> dict:
    from runledger.plans.oracle_sql import ORACLE
    from runledger.plans.queries import QUERIES
    con = con or duck(sf_dir)
    s_cols, s_rows = _rows_spark(QUERIES[name](spark, sf_dir))
    d_cols, d_rows = _rows_duck(con.sql(ORACLE[name]))
    s_sorted, d_sorted = sorted(s_rows), sorted(d_rows)
    res = {
        "name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": s_cols == d_cols, "values_match": s_sorted == d_sorted,
    }
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    elif not res["values_match"]:
        from collections import Counter
        cs, cd = Counter(s_sorted), Counter(d_sorted)
        res["only_spark"] = list((cs - cd).elements())[:show]
        res["only_oracle"] = list((cd - cs).elements())[:show]
    res["ok"] = res["cols_match"] and res["values_match"]
    return res


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from runledger.session import get_spark
    from runledger.plans.oracle_sql import ORACLE
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "8g"})
    names = sys.argv[1:] or sorted(ORACLE)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
