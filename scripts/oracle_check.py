"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows (spark/oracle), column match, value match.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlake.sources.fixtures import BASE_TABLES  # noqa: E402


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{v:.6g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records), [columns[i] for i in order]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def pandas_view(pdf):
    """Columns sorted by name; values as text the way pandas prints them."""
    pdf = pdf[sorted(pdf.columns)]
    out = pdf.astype(str)
    return sorted(map(tuple, out.values.tolist())), [str(t).replace("[us]", "").replace("[ns]", "")
                                                      for t in pdf.dtypes]


def compare_pandas(spark, sf_dir, keys=None, verbose=True):
    """Stricter check: Spark ``toPandas`` against DuckDB ``.df()`` (dtypes and text values)."""
    from flowlake.plans.catalog import ORACLE, QUERIES

    con = duck(sf_dir)
    bad = {}
    for key in keys or sorted(ORACLE):
        a_rows, a_types = pandas_view(QUERIES[key](spark, sf_dir).toPandas())
        b_rows, b_types = pandas_view(con.execute(ORACLE[key]).df())
        ok = a_rows == b_rows and a_types == b_types
        if not ok:
            bad[key] = (a_types, b_types)
        if verbose:
            print(key, "pandas ok" if ok else f"pandas MISMATCH {a_types} vs {b_types}", flush=True)
    return bad


def compare(spark, sf_dir, keys=None, verbose=True):
    from flowlake.plans.catalog import ORACLE, QUERIES

    con = duck(sf_dir)
    results = {}
    for key in keys or sorted(QUERIES):
        t0 = time.time()
        df = QUERIES[key](spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        t_spark = time.time() - t0
        res = {"spark_rows": len(s_rows), "sec": round(t_spark, 2)}
        if key in ORACLE:
            cur = con.execute(ORACLE[key])
            o_cols = [d[0] for d in cur.description]
            o_rows = cur.fetchall()
            a, ac = rows_of(df.columns, s_rows)
            b, bc = rows_of(o_cols, o_rows)
            res.update(oracle_rows=len(o_rows), cols=ac == bc, values=a == b)
            if verbose and not (ac == bc and a == b):
                print("  spark cols", ac, "\n  oracle cols", bc)
                sa, sb = set(a), set(b)
                print("  only spark:", list(sa - sb)[:3], "\n  only oracle:", list(sb - sa)[:3])
        results[key] = res
        if verbose:
            print(key, res, flush=True)
    return results


if __name__ == "__main__":
    from flowlake.session import build_session

    args = [a for a in sys.argv[1:] if a != "--pandas"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or None
    spark = build_session()
    if "--pandas" in sys.argv:
        print("PANDAS MISMATCH:", list(compare_pandas(spark, sf, keys)) or "none")
        raise SystemExit(0)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if "values" in v and not (v["cols"] and v["values"])]
    print("MISMATCH:", bad if bad else "none", "| no oracle:",
          [k for k, v in res.items() if "values" not in v])
