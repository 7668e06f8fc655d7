"""Functions of the library over literal rows."""

import duckdb
import pytest
from literals import ORACLES, QUERIES
from test_catalog import shown


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_literals(spark, sf, name):
    got, found = QUERIES[name](spark, sf), duckdb.connect().execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert shown(got.select(columns).collect()) == shown(found.fetchall())
