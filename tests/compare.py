"""Compare a Spark result with the oracle's, value by value and type by type."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, decimal.Decimal)):
        return (2, str(int(v)) if v == int(v) else str(v))
    if isinstance(v, float):
        return (3, repr(v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return (4, v.isoformat())
    return (5, str(v))


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the first difference."""
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference in {got_names}:\n  spark  {g}\n  oracle {w}"
    return None
