"""Compare a Spark result with the oracle's, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from provtrail.sources.tables import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str):
    """None when equal, else a short text."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    if a == b:
        return None
    return f"rows {len(got)} vs {len(want)}; only spark {list((a - b).items())[:3]}; only oracle {list((b - a).items())[:3]}"
