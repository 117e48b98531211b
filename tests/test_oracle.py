"""Every query with an SQL counterpart returns the same rows as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import DATA, connect, difference

FOLDER = f"{DATA}/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert difference(got, con.execute(SQL[name]).df()) == ""


def test_every_counterpart_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 150 and len(df.columns) == 17
