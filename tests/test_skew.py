"""Tables in which one customer, supplier and day hold a third of the rows."""

import duckdb
import pytest
from conftest import SMALL
from oracle import connect, differences

import oracle_queries
from registered_queries import QUERIES, Frames
from wardflow.plans import intermediate

ORACLE = oracle_queries.build()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    hot = {
        "orders": """* REPLACE (
            CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 10 = 1 THEN NULL
                ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 6 = 0 THEN TIMESTAMP '1999-05-05' ELSE o_orderdate END
                AS o_orderdate)""",
        "lineitem": """* REPLACE (
            CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey)""",
        "supplier": "*",
        "nation": "*",
    }
    for name, columns in hot.items():
        duckdb.sql(
            f"COPY (SELECT {columns} FROM '{SMALL}/{name}.parquet') "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "stg_providers",
        "int_providers_enriched",
        "int_readmissions_flagged",
        "readmission_rate_by_condition_state",
        "audit_ref_integrity",
        "test_unique",
        "test_relationships",
    ],
)
def test_same_result(spark, skewed, name):
    assert differences(QUERIES[name](spark, skewed), connect(skewed), ORACLE[name]) is None


@pytest.mark.parametrize("rows_per_slice", [500, 50, 5])
def test_flags_are_the_same_however_histories_are_cut(spark, skewed, rows_per_slice):
    flagged = intermediate.int_readmissions_flagged(
        Frames(spark, skewed).raw.events, rows_per_slice=rows_per_slice
    )
    expected = ORACLE["int_readmissions_flagged"]
    assert differences(flagged, connect(skewed), expected) is None
