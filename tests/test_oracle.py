"""Every registered query against its SQL in DuckDB."""

import pytest
from conftest import SMALL
from oracle import connect, differences

import __spark_entry__ as entry_module
import oracle_queries
from registered_queries import QUERIES

ORACLE = oracle_queries.build()


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, database, name):
    assert differences(QUERIES[name](spark, SMALL), database, ORACLE[name]) is None


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == [
        "condition_name",
        "state",
        "total_admissions",
        "readmission_count",
        "readmission_rate_pct",
    ]
    assert result.count() > 0
