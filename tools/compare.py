"""Run registered queries in Spark and their SQL in DuckDB and compare rows.

    python tools/compare.py [--sf DIR] [name or prefix* …]
"""

from __future__ import annotations

import argparse
import fnmatch
import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64").map(lambda x: repr(x) if pd.notna(x) else "null")
        else:
            df[c] = df[c].map(lambda x: "null" if x is None or (isinstance(x, float) and pd.isna(x)) or x is pd.NaT else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def kinds(df: pd.DataFrame) -> dict:
    def kind(s):
        if pd.api.types.is_bool_dtype(s):
            return "bool"
        return {"i": "num", "u": "num", "f": "num", "M": "time"}.get(s.dtype.kind, "obj")
    return {c: kind(df[c]) for c in sorted(df.columns)}


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from registered import all_queries, all_sql

    queries, sql = all_queries(), all_sql()
    names = [n for n in queries if not args.names or any(fnmatch.fnmatch(n, p) for p in args.names)]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.host", "localhost").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad = []
    for n in names:
        begin = time.time()
        try:
            got = queries[n](spark, args.sf).toPandas()
            took = time.time() - begin
            if n not in sql:
                print(f"rows  {n:40s} {len(got):7d} rows {took:6.2f}s", flush=True)
                if not len(got):
                    bad.append(n)
                continue
            begin = time.time()
            want = con.execute(sql[n]).df()
            sql_took = time.time() - begin
            if sorted(got.columns) != sorted(want.columns):
                bad.append(n)
                print(f"COLS  {n}: {sorted(got.columns)} vs {sorted(want.columns)}", flush=True)
                continue
            a, b = canonical(got), canonical(want)
            same = len(a) == len(b) and a.equals(b)
            note = "" if kinds(got) == kinds(want) else f" kinds differ {[(c, k, kinds(want)[c]) for c, k in kinds(got).items() if kinds(want)[c] != k]}"
            print(f"{'ok   ' if same else 'DIFF '} {n:40s} {len(a):7d} / {len(b):7d} rows {took:6.2f}s sql {sql_took:5.2f}s{note}", flush=True)
            if not same:
                bad.append(n)
                if len(a) == len(b):
                    off = (a != b)
                    cols = [c for c in a.columns if off[c].any()]
                    rows = off.any(axis=1)
                    print("   columns:", cols, int(rows.sum()), "rows")
                    print(pd.concat([a[rows].head(4), b[rows].head(4)]).to_string())
                else:
                    print(a.head(4).to_string()); print(b.head(4).to_string())
        except Exception:
            bad.append(n)
            print(f"FAIL  {n}")
            print("\n".join(traceback.format_exc().splitlines()[-12:])[:2500], flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
