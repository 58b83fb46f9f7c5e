"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


DIGITS = None if os.environ.get("ORACLE_EXACT") else 9


def norm(v, digits: int | None = 9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits is None else round(v, digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(v) if digits is None else round(float(v), digits)
    return v


def canon(cols, rows, digits=9):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


# Spark simpleString -> DuckDB type name, for the schema check
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, sf_dir, key, fn, sql, digits=DIGITS):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        wrong = [(c, s_types[c], d_types.get(c)) for c in s_cols
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types.get(c)]
        if wrong:
            problems.append(f"types {wrong}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a = canon(s_cols, s_rows, digits)
        b = canon(d_cols, d_rows, digits)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            problems.append(f"{len(diff)} differing rows, e.g. {diff[:2]}")
    return problems, len(s_rows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from riskweave.session import build_session
    import __spark_entry__ as E

    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        if key not in oracle:
            t0 = time.time()
            try:
                n = qs[key](spark, sf_dir).count()
                print(f"ROWS  {key}: {n} rows ({time.time() - t0:.1f}s, no oracle)")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {key}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            problems, n, ts, td = compare(spark, con, sf_dir, key, qs[key], oracle[key])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {key}: {type(e).__name__}: {str(e)[:600]}")
            continue
        if problems:
            bad += 1
            print(f"FAIL  {key}: {'; '.join(problems)[:1500]}")
        else:
            print(f"OK    {key}: {n} rows (spark {ts:.1f}s, duckdb {td:.2f}s)")
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
