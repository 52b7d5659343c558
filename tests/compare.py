"""Run registered queries next to their SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _clean(v):
    if isinstance(v, float) and not math.isnan(v):
        return 0.0 if v == 0 else v
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_clean(r[n]) for n in names) for r in df.collect()), key=_key)


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted((tuple(_clean(r[i]) for i in order) for r in cursor.fetchall()), key=_key)


def difference(df, con, sql):
    """None when names, row count and values agree, else a short account."""
    ours, theirs = spark_rows(df), sql_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours[1])} rows differ, first {bad[:2]}"
    return None
