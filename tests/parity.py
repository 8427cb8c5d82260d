"""Spark-vs-DuckDB parity check of registered queries.

Usage: python tests/parity.py [sf_dir] [query ...]

Compares row count, column names and an order-insensitive multiset of
canonical row values, the way the driver's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def canon(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(canon(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                 "tinyint": "TINYINT"}


def type_mismatches(df, res) -> list[str]:
    """Columns whose Spark and DuckDB types differ (decimals by precision/scale)."""
    duck = {c[0]: str(c[1]) for c in res.description}
    out = []
    for f in df.schema.fields:
        s_t = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(s_t, s_t.upper())
        got = duck.get(f.name, "?").upper()
        if got != want:
            out.append(f"{f.name}: spark {s_t} vs duckdb {got}")
    return out


def duck_conn(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows),
               spark_s=round(t1 - t0, 2))
    types = type_mismatches(df, res)
    if types:
        out["types"] = types
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"cols spark-only={sorted(set(s_cols)-set(d_cols))} "
                                 f"oracle-only={sorted(set(d_cols)-set(s_cols))}")
        return out
    a, b = rows_multiset(s_cols, s_rows), rows_multiset(d_cols, d_rows)
    if a != b:
        diff_a = list((a - b).elements())[:3]
        diff_b = list((b - a).elements())[:3]
        out.update(ok=False, why=f"values differ: spark {diff_a} oracle {diff_b} "
                                 f"cols={sorted(s_cols)}")
        return out
    out.update(ok=True)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from ledgerlake.session import build_session
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, name, qs[name], sqls.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
