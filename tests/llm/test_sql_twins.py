"""Registered queries of the training-data operators against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from chronogrid.llm import queries
from tests.test_queries import canonical

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(queries.ORACLE[name])
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert canonical(got.select(*columns).collect()) == canonical([tuple(r[k] for k in order) for r in want.fetchall()])
