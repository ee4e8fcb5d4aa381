"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-free exact values). Used by the tests and by
hand: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    st = {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_df.dtypes}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(spark_df, con, sql: str, tol: float = 0.0):
    cols = spark_df.columns
    srows = [tuple(_norm(r[c]) for c in sorted(cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    drows = [tuple(_norm(r[dcols.index(c)]) for c in sorted(dcols)) for r in drows_raw]
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "names": sorted(cols) == sorted(dcols), "types": type_mismatches(spark_df, con, sql)}
    if not out["names"]:
        out["spark_cols"], out["oracle_cols"] = sorted(cols), sorted(dcols)
        return out
    srows.sort(key=_key)
    drows.sort(key=_key)
    exact = srows == drows
    out["exact"] = exact
    if not exact and len(srows) == len(drows):
        bad = 0
        first = None
        for a, b in zip(srows, drows):
            for x, y in zip(a, b):
                if x == y:
                    continue
                if isinstance(x, float) and isinstance(y, float) and abs(x - y) <= tol * max(1, abs(y)):
                    continue
                bad += 1
                if first is None:
                    first = (a, b)
                break
        out["bad_rows"] = bad
        out["first_diff"] = first
    return out


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    import os
    if os.environ.get("ORACLE_PLAIN_SESSION"):  # like a caller's own default session
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from meterflow.session import build_session
        spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    ok = True
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        if name not in os_:
            n = df.count()
            print(f"{name:28s} rows-only {n} ({time.time() - t:.1f}s)")
            continue
        r = compare(df, con, os_[name])
        good = (r.get("exact") and r["names"] and not r["types"]
                and r["spark_rows"] == r["oracle_rows"])
        ok &= bool(good)
        print(f"{name:28s} {'OK ' if good else 'BAD'} {r} ({time.time() - t:.1f}s)", flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
