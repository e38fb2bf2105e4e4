"""Every registered query against its SQL twin, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from chronogrid.plans import registry

SF = "/root/testdata/sf0.001"


def canonical(rows):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return float(f"{v:.9g}")
        return str(v) if isinstance(v, (datetime.datetime, bytes)) else v

    return sorted((tuple(map(one, r)) for r in rows), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(registry.oracle_sql()[name])
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert canonical(got.select(*columns).collect()) == canonical([tuple(r[k] for k in order) for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
