"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Mirrors the driver's check: row count, column names, and an order-insensitive
comparison of values.  Floats are compared exactly *and* after rounding to 9
decimals, so that a result which only matches approximately is visible.

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, _dt.datetime) and v.tzinfo is not None:
        return v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(rows, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def type_mismatches(df, con, sql):
    """Columns whose DuckDB type does not map to the Spark type (e.g. HUGEINT vs bigint)."""
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in df.schema.fields:
        d = duck_types.get(f.name)
        if d is not None and DUCK_TO_SPARK.get(d) != f.dataType.simpleString():
            out.append((f.name, f.dataType.simpleString(), d))
    return out


def compare(spark, sf_dir, name, fn, sql, con=None):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "rows_spark": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["rows_duck"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ spark={s_cols} duck={d_cols}"
        return res
    if len(s_rows) != len(d_rows):
        res["status"] = "ROWCOUNT differ"
        return res
    exact = _rows(s_rows, s_cols, None) == _rows(d_rows, d_cols, None)
    approx = _rows(s_rows, s_cols, 9) == _rows(d_rows, d_cols, 9)
    res["status"] = "exact" if exact else ("approx9" if approx else "VALUES differ")
    bad_types = type_mismatches(df, con, sql)
    if bad_types:
        res["status"] = f"TYPES differ {bad_types}"
    if not approx:
        a, b = _rows(s_rows, s_cols, 9), _rows(d_rows, d_cols, 9)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = diff
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    from liftlens.plans.catalog import ORACLE, QUERIES
    from liftlens.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(cpus=8, shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, QUERIES[n], ORACLE.get(n), con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("exact", "approx9", "rows-only")
        bad += not ok
        print(("ok  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
