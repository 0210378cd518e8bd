"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import FOLDER
from tools.check import connect, differences
from velogrid.registry import queries as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_counterpart_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name in SQL:
        result = db.execute(SQL[name])
        assert differences((df.columns, rows), ([d[0] for d in result.description], result.fetchall())) == ""
    else:
        assert rows


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
