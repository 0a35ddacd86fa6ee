"""Compare a query with its SQL twin: same column names, same rows in any order, exact values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x).__name__), str(x)) for x in r))


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when both sides agree."""
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            out.append(f"\n   got {g}\n  want {w}")
            if len(out) > limit:
                break
    return out if not got == want or out else []
