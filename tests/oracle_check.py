"""Compare a registered Spark query with its DuckDB oracle (row count, columns, values).

Usable from pytest and as a CLI:  python tests/oracle_check.py SF_DIR [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from strata.plans.views import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else float(f"{float(v):.10g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, key: str, fn, sql: str | None):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return {"key": key, "rows": len(s_rows), "oracle": None, "ok": None}
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    out = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_ok": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_ok"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
        out["ok"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_oracle"] = list(sb - sa)[:3]
    return out


if __name__ == "__main__":
    import time

    from strata.plans import ORACLES, QUERIES
    from strata.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN_SESSION") == "1":   # a bare session, as another harness might build it
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
        if os.environ.get("SESSION_TZ"):
            spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    else:
        spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duck(sf)
    bad = 0
    for k in keys:
        t = time.time()
        try:
            r = compare(spark, con, sf, k, QUERIES[k], ORACLES.get(k))
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad, "of", len(keys))
