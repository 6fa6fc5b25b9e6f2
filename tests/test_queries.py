import __spark_entry__ as entry
import pytest
from compare import difference, oracle, oracle_rows, spark_rows

from lanehouse.workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    if name in ORACLES:
        assert difference(got, oracle_rows(connection, ORACLES[name])) is None
    else:
        assert got[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
