"""Each query with SQL gives what DuckDB gives."""

import duckdb
import pytest

from palimpsest.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations clicks".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, found.fetchall()))
