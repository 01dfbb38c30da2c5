import pytest

from __spark_entry__ import entry
from check import differs, oracle_tables
from tidelog.plans import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return oracle_tables(SMALL)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    sql = ORACLES[name]
    assert tables.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0] > 0
    assert differs(QUERIES[name](spark, SMALL), tables, sql) is None


def test_entry(spark):
    assert entry(spark).count() == 5
