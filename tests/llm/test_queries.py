"""Registered corpus queries against their SQL on the small tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
KEYS = sorted(k for k in entry.queries() if k == "pipeline" or k.startswith("op") and k[2].isdigit())


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, key):
    df = entry.queries()[key](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if key in entry.oracle_sql():
        con = duckdb.connect()
        for name in ("documents", "pages", "benchmark", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        result = con.execute(entry.oracle_sql()[key])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        place = [df.columns.index(n) for n in names]
        assert Counter(tuple(r[i] for i in place) for r in rows) == Counter(result.fetchall())


def test_every_operator_has_a_query():
    assert [sum(k.startswith(f"op{n}_") for k in KEYS) for n in range(1, 14)] == [1] * 13 and "pipeline" in KEYS
