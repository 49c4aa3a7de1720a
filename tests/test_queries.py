"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import math
import os

import duckdb
import pytest

from tributary.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    found = duckdb.connect()
    for name in os.listdir(SF):
        found.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return found


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    out = QUERIES[name](spark, SF)
    rows = out.collect()
    if name not in SQL:
        assert rows
        return
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(out.columns)
    wanted = sorted(tuple(plain(v) for v in row) for row in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in names) for r in rows) == wanted
