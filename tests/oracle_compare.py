"""Spark-vs-DuckDB comparison: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
import os
import sys

EXACT = os.environ.get("ORACLE_EXACT") == "1"   # compare floats bit for bit

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = rows_of(o_cols, res.fetchall())
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}")
    if len(s_rows) != len(o_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(o_rows)}")
    elif s_rows != o_rows:
        bad = [(a, b) for a, b in zip(s_rows, o_rows) if a != b]
        problems.append(f"{len(bad)} rows differ; first: spark={bad[0][0]} oracle={bad[0][1]}")
    return problems, len(s_rows)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import time

    import __spark_entry__ as E
    from clinframe import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    oracle = E.oracle_sql()
    failed = 0
    for name, q in E.queries().items():
        if only and name not in only:
            continue
        if name not in oracle:
            print(f"{name:24s} (no oracle)")
            continue
        t = time.time()
        try:
            problems, n = compare(q(spark, sf_dir), con, oracle[name])
        except Exception as e:  # report and continue
            problems, n = [f"{type(e).__name__}: {str(e)[:400]}"], -1
        failed += bool(problems)
        print(f"{name:24s} {'OK ' if not problems else 'BAD'} rows={n:6d} {time.time() - t:5.1f}s "
              + "; ".join(problems), flush=True)
    print("FAILED", failed)
