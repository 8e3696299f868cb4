"""Run every catalogue query in Spark and its DuckDB oracle on the same tables and compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows (spark/duckdb), column check and an order-insensitive value check.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from epistand.plans.catalogue import queries  # noqa: E402
from epistand.plans.oracle import oracle_sql  # noqa: E402
from epistand.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, datetime.datetime):
        return v.date().isoformat() if v.time() == datetime.time() else v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    sql = oracle_sql()
    bad = 0
    for name, fn in sorted(queries().items()):
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            s_cols = sdf.columns
            s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sql:
            print(f"{name:32s} spark={len(s_rows)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
            d_types = {c[0]: str(c[1]) for c in res.description}
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        cols_ok = sorted(s_cols) == sorted(d_cols)
        type_bad = {c: (s_types[c], d_types[c]) for c in s_cols
                    if c in d_types and TYPE_MAP.get(s_types[c]) != d_types[c]}
        vals_ok = cols_ok and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
        ok = cols_ok and vals_ok and len(s_rows) == len(d_rows)
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} spark={len(s_rows)} duck={len(d_rows)} cols={cols_ok} "
              f"vals={vals_ok} types={'ok' if not type_bad else type_bad} {t1 - t0:.1f}s")
        if not cols_ok:
            print("   spark cols", s_cols, "\n   duck cols ", d_cols)
        elif not vals_ok:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            sa, sb = set(a), set(b)
            print("   cols", sorted(s_cols))
            print("   spark types", s_types, "\n   duck types", d_types)
            print("   only spark", sorted(sa - sb, key=str)[:4])
            print("   only duck ", sorted(sb - sa, key=str)[:4])
    print("FAILED", bad)


if __name__ == "__main__":
    main()
