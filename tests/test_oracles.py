"""Every query of the catalog runs; those with SQL give the rows DuckDB gives."""

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    if name in ORACLES:
        wanted_columns, wanted = duck_rows(duck, ORACLES[name])
        assert columns == wanted_columns
        assert rows == wanted
    else:
        assert rows
