"""What the plans must look like for large tables."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from registered_queries import QUERIES
from wardflow.operators.history import with_previous


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"dq_suite"}))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"):
        assert node not in text


def test_latest_record_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["stg_providers"](spark, SMALL))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("Exchange hashpartitioning(providerCcn") < partial


def test_rollup_reads_only_its_columns(spark):
    text = plan(QUERIES["penalty_bands"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    read = {name.split(":")[0] for schema in schemas for name in schema.split(",")}
    assert not read & {"l_extendedprice", "l_quantity", "l_tax", "l_discount", "s_name"}


def test_window_is_dropped_where_no_flag_is_read(spark):
    for name in ("audit_ref_integrity", "test_relationships"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "lag(" not in text


def test_admissions_are_counted_before_they_meet_a_dimension(spark):
    text = plan(QUERIES["readmission_rate_by_condition_state"](spark, SMALL))
    joins = [line for line in text.splitlines() if "Join" in line and "facility_id" in line]
    assert joins
    fact_side = text[text.index(joins[0]) :]
    assert "keys=[facility_id" in fact_side and "lag(" in fact_side
    assert fact_side.index("keys=[facility_id") < fact_side.index("lag(")


def test_flagging_shuffles_admissions_once(spark):
    df = QUERIES["int_readmissions_flagged"](spark, SMALL)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    # No patient has a long history: a plain window, one full shuffle.
    assert final.count("Exchange hashpartitioning") == 1
    assert "Join" not in final


def test_a_person_with_a_third_of_all_rows_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(30_000).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, "busy").otherwise((F.col("id") % 997).cast("string")).alias("who"),
            F.expr("date_add(DATE'2024-01-01', CAST(id % 5 AS INT))").alias("day"),
        )
        result = with_previous(df, "who", ["day", F.length("id"), "id"], ["id"], rows_per_slice=200)
        sizes = [
            r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()
        ]
        text = plan(result)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 30_000 and max(sizes) < 6_000
    # Neither window on long groups keeps a group together.
    windows = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert sum("_slice" in keys or "_w" in keys for keys in windows) >= 2
