"""Every registered query against its SQL in DuckDB."""

import oracle
import pytest

import __spark_entry__ as entry
from ledgerloom.plans import oracles, queries

SF = "/root/testdata/sf0.001"
QUERIES = queries.QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 22 and df.count() == 17


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles.ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(row) for row in df.collect()]
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert oracle.compare(df.columns, rows, columns, cursor.fetchall()) == ""
