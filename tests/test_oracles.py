"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tamiz.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def shown(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    return repr(round(x, 6) + 0.0) if isinstance(x, float) else str(x)


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(shown(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    values = [tuple(r) for r in got.collect()]
    if name not in registry.ORACLES:
        assert values
        return
    want = duck.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert [TYPES[dict(got.dtypes)[c]] for c in sorted(got.columns)] == [str(t) for _, t in sorted(zip(want.columns, want.types))]
    assert rows(got.columns, values) == rows(list(want.columns), want.fetchall())
