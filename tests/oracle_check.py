"""Run ``queries()`` on Spark and ``oracle_sql()`` on DuckDB and compare.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``. Prints one line
per query and exits non-zero on any mismatch. Also imported by the tests.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda t: tuple("" if x is None else x for x in t),
    )
    return cols, out


def compare_frame(df, sql: str, con) -> str:
    """``ok`` or a description of the first difference."""
    sc, sr = normalise(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    dc, dr = normalise([c[0] for c in cur.description], cur.fetchall())
    if sc != dc:
        return f"schema {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rowcount {len(sr)} vs {len(dr)}"
    if sr != dr:
        return f"values {[(a, b) for a, b in zip(sr, dr) if a != b][:3]}"
    return "ok"


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duckdb_connection(sf_dir)
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    result = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        result["status"] = "no-oracle"
        return result
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    result["oracle_rows"] = len(d_rows)
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    if sc != dc:
        result["status"] = f"schema {sc} vs {dc}"
    elif len(sr) != len(dr):
        result["status"] = "rowcount"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        result["status"] = f"values {diff}"
    else:
        result["status"] = "ok"
    return result


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from tillroll.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(E.queries())
    spark = local_session(8)
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, sf_dir, name, con)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"error {type(exc).__name__}: {str(exc)[:300]}"}
        ok = r["status"] in ("ok", "no-oracle")
        bad += not ok
        print(("PASS " if ok else "FAIL ") + str(r), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
