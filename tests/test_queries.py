"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from lanepulse.plans import catalog

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

ORACLE = entry.oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.registry()}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield connection
    connection.close()


def _canonical(columns, rows) -> list[tuple]:
    """Rows as sorted tuples, columns by name, all numbers as floats."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return float(v)
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_each_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = oracle.sql(ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    got = _canonical(found.columns, found.collect())
    assert got == _canonical(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
