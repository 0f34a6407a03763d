"""Row-by-row comparison of a Spark query with its SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from liftplan.suite.queries import ORACLES, QUERIES
from liftplan.suite.registry import TABLES


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in rows)


def compare_key(spark, con, folder: str, key: str):
    """(problem or None, Spark row count); values and types must be equal."""
    df = QUERIES[key](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        return None, len(rows)
    res = con.execute(ORACLES[key])
    names = [d[0] for d in res.description]
    expected = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(rows)
    a, b = _bag(df.columns, rows), _bag(names, expected)
    if a == b:
        return (None if rows else "no rows"), len(rows)
    only_a, only_b = a - b, b - a
    head = lambda c: [[v for _, v in r] for r in list(c)[:2]]
    types = [[t for t, _ in r] for r in list(only_a)[:1] + list(only_b)[:1]]
    return (f"spark={len(rows)} sql={len(expected)} only spark {sum(only_a.values())} {head(only_a)} "
            f"only sql {sum(only_b.values())} {head(only_b)} types {types} columns {sorted(names)}"), len(rows)
