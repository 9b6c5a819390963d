"""Run registered queries on Spark and their SQL twins on DuckDB, compare like the driver does:
row count, column names and types, and the order-insensitive multiset of values.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""
from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _spark_type_family(t) -> str:
    n = t.simpleString()
    return n.replace("timestamp_ntz", "timestamp")


_DUCK_MAP = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint",
             "TIMESTAMP": "timestamp", "DATE": "date", "DOUBLE": "double", "BOOLEAN": "boolean",
             "HUGEINT": "hugeint", "TINYINT": "tinyint"}


def _duck_type(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK_MAP.get(t, t.lower())


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sorted(sdf.columns)
            s_types = {f.name: _spark_type_family(f.dataType) for f in sdf.schema.fields}
            s_rows = sorted((tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()), key=repr)
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name])
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = f"rows-only {len(s_rows)}"
            if verbose:
                print(f"{name:34s} {out[name]}  spark {t1 - t0:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = sorted(rel.columns)
            d_types = dict(zip(rel.columns, [_duck_type(t) for t in rel.types]))
            data = rel.fetchall()
            idx = [rel.columns.index(c) for c in d_cols]
            d_rows = sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=repr)
        except Exception as e:  # noqa: BLE001
            out[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name])
            continue
        problems = []
        if s_cols != d_cols:
            problems.append(f"cols spark-only={set(s_cols) - set(d_cols)} duck-only={set(d_cols) - set(s_cols)}")
        else:
            tdiff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
            if tdiff:
                problems.append(f"types {tdiff}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        elif s_rows != d_rows:
            diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
            problems.append(f"values differ e.g. {diff}")
        out[name] = "OK" if not problems else "; ".join(problems)
        if verbose:
            print(f"{name:34s} {out[name][:600]}  rows={len(s_rows)} spark {t1 - t0:.1f}s")
    return out


if __name__ == "__main__":
    from acqlens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok or rows-only; failing: {sorted(bad)}")
