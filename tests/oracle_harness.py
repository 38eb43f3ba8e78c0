"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle.

Rows are compared order-insensitively after sorting columns by name.
"""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("num", round(v, 6))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", float(v))
    if hasattr(v, "tolist"):
        return ("arr", str(v.tolist()))
    if isinstance(v, (list, tuple)):
        return ("arr", str(list(v)))
    return ("str", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr), [cols[i] for i in order]


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    if sql is None:
        return True, f"rows-only: {len(s_rows)} rows"
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: str(c[1]) for c in res.description}
    d_rows = res.fetchall()
    bad_types = [(c, t, d_types.get(c)) for c, t in s_types.items() if TYPES.get(t, t) != d_types.get(c)]
    if bad_types:
        return False, f"column types differ: {bad_types}"
    sr, sc = rows_of(s_cols, s_rows)
    dr, dc = rows_of(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first diff cols={sc}\n spark={a}\n duck ={b}"
    return True, f"{len(sr)} rows"


if __name__ == "__main__":
    import os
    import time
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tabulon.session import get_session
    import __spark_entry__ as E
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = set(sys.argv[1:])
    spark = get_session("local[8]", 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            ok, msg = compare(spark, con, name, fn, sqls.get(name), sf)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time()-t0:5.1f}s {msg}", flush=True)
    print(f"{len(qs) - bad}/{len(qs)} ok" if not only else f"{bad} bad")
