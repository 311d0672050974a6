"""Run a registered query and its SQL, and tell how they differ."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v:.6f}" if isinstance(v, float) else str(v)


def _lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("\x1f".join(f"{type(r[i]).__name__ if r[i] is not None else ''}:{_cell(r[i])}" for i in order) for r in rows)


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def differences(df, sql: str, sf_dir: str) -> list[str]:
    names, rows = oracle(sql, sf_dir)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    out = []
    if sorted(names) != sorted(got_names):
        return [f"columns {sorted(got_names)} against {sorted(names)}"]
    want, have = _lines(names, rows), _lines(got_names, got)
    if len(want) != len(have):
        out.append(f"rows {len(have)} against {len(want)}")
    if want != have:
        extra = sorted(set(have) - set(want))[:2]
        missing = sorted(set(want) - set(have))[:2]
        out.append(f"extra {extra} missing {missing}")
    return out
