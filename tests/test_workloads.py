import duckdb
import pytest

from workloads import ORACLES, QUERIES
from workloads.check import TABLES, row_counter

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{TINY}/{name}.parquet'")
    return connection


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    result = QUERIES[name](spark, TINY)
    mine = row_counter(result.columns, result.collect())
    assert mine
    if name in ORACLES:
        relation = db.sql(ORACLES[name])
        assert sorted(relation.columns) == sorted(result.columns)
        assert mine == row_counter(relation.columns, relation.fetchall())
