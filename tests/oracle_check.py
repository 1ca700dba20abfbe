"""Run queries() against oracle_sql() the way the driver's correctness gate does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    return v


def canon(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t_spark = time.time() - t0
        rec = {"spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
        if name in sqls:
            res = con.execute(sqls[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
            rec["oracle_rows"] = len(d_rows)
            rec["columns_match"] = sorted(s_cols) == sorted(d_cols)
            rec["values_match"] = rec["columns_match"] and canon(s_cols, s_rows) == canon(d_cols, d_rows)
            if not rec["values_match"]:
                rec["spark_cols"], rec["oracle_cols"] = s_cols, d_cols
                a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                rec["first_diffs"] = diff
        report[name] = rec
        print(name, rec, flush=True)
    return report


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rep = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if "values_match" in v and not v["values_match"]]
    print("MISMATCH:", bad)
    sys.exit(1 if bad else 0)
