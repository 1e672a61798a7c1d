"""Runs registered queries against their DuckDB SQL: python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0)
                                           for v in r))


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    result = con.sql(sql)
    want_columns, want = result.columns, result.fetchall()
    have = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    a, b = _sorted(df.columns, have), _sorted(want_columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    kinds = {(type(p), type(q)) for x, y in zip(a, b) for p, q in zip(x, y)
             if p is not None and q is not None and type(p) is not type(q)}
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}"
    return f"types differ: {kinds}" if kinds else None


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT))
    from tests.conftest import make_session
    import __spark_entry__ as e

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark, con = make_session(), duck(sf)
    names = sys.argv[2:] or list(e.queries())
    for name in names:
        start = time.time()
        try:
            df = e.queries()[name](spark, sf)
            sql = e.oracle_sql().get(name)
            found = difference(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as ex:  # report and go on
            found = f"{type(ex).__name__}: {str(ex)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {found or 'ok'}", flush=True)
