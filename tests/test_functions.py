import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow import functions as W
from wardflow.functions import casts

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# prior discharge, admission, type, diagnosis -> flag
TRUTH = [
    (None, D(2026, 1, 31), "Emergency", "AMI", False),
    (D(2026, 1, 1), D(2026, 1, 1), "Emergency", "AMI", True),
    (D(2026, 1, 1), D(2026, 1, 2), "Emergency", "AMI", True),
    (D(2026, 1, 1), D(2026, 1, 30), "Emergency", "AMI", True),
    (D(2026, 1, 1), D(2026, 1, 31), "Emergency", "AMI", True),
    (D(2026, 1, 1), D(2026, 2, 1), "Emergency", "AMI", False),
    (D(2026, 1, 5), D(2026, 1, 1), "Emergency", "AMI", False),
    (D(2026, 1, 1), D(2026, 1, 9), "Planned", "Cancer Treatment", False),
    (D(2026, 1, 1), D(2026, 1, 9), "Planned", "Rehabilitation", False),
    (D(2026, 1, 1), D(2026, 1, 9), "Planned", "Transplant", False),
    (D(2026, 1, 1), D(2026, 1, 9), "Emergency", "Cancer Treatment", True),
    (D(2026, 1, 1), D(2026, 1, 9), "Planned", "AMI", True),
    (D(2026, 1, 1), D(2026, 1, 9), "planned", "Transplant", True),
    (D(2026, 1, 1), D(2026, 1, 9), None, "Transplant", None),
    (D(2026, 1, 1), D(2026, 1, 9), None, "AMI", True),
    (D(2026, 1, 1), D(2026, 1, 9), "Planned", None, None),
    (D(2026, 1, 1), D(2026, 1, 9), "Elective", None, True),
    (D(2026, 1, 1), None, "Emergency", "AMI", None),
    (D(2026, 1, 1), D(2026, 3, 9), None, "Transplant", False),
    (None, None, None, None, False),
]


def test_is_readmission_truth_table(rows):
    df = rows(
        [(i, *case) for i, case in enumerate(TRUTH)],
        "i int, prior date, adm date, type string, diag string, want boolean",
    )
    rule = W.is_readmission(F.col("prior"), F.col("adm"), F.col("type"), F.col("diag"))
    got = {r["i"]: (r["got"], r["want"]) for r in df.withColumn("got", rule).collect()}
    assert {i: g for i, (g, w) in got.items() if g != w} == {}


def test_is_readmission_parameters(rows):
    df = rows([(D(2026, 1, 1), D(2026, 1, 9), "Planned", "AMI")], "p date, a date, t string, d string")
    rule = [F.col(c) for c in "patd"]
    row = df.select(
        W.is_readmission(*rule, window_days=7).alias("short"),
        W.is_readmission(*rule, exclusions=("AMI",)).alias("excluded"),
    ).first()
    assert (row["short"], row["excluded"]) == (False, False)


@pytest.mark.parametrize(
    "text,want",
    [
        ("17", 17),
        ("0", 0),
        ("Not Available", None),
        ("Not Applicable", None),
        ("Too Few to Report", None),
        ("N/A", None),
        ("", None),
        (None, None),
        ("about 5", None),
        ("not available", None),
    ],
)
def test_safe_cast_int(spark, text, want):
    assert one(spark, W.safe_cast_int(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "text,want",
    [("0.95", 0.95), ("-1e3", -1000.0), ("Too Few to Report", None), ("x", None), (None, None)],
)
def test_safe_cast_double(spark, text, want):
    assert one(spark, W.safe_cast_double(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-06-30", D(2024, 6, 30)),
        ("06/30/2024", D(2024, 6, 30)),
        ("13/45/2024", None),
        ("N/A", None),
        ("Too Few to Report", None),
        ("", None),
        (None, None),
    ],
)
def test_safe_cast_date(spark, text, want):
    assert one(spark, W.safe_cast_date(F.lit(text).cast("string"))) == want


def test_sentinel_lists_differ_per_site(spark):
    # A listed text is NULL by the list, an unlisted one by being unreadable.
    for sentinels in (casts.METRIC_SENTINELS, casts.RATING_SENTINELS, ()):
        for text in casts.COUNT_SENTINELS:
            assert one(spark, W.sentinel_cast(F.lit(text), "int", sentinels)) is None
    assert one(spark, W.sentinel_cast(F.lit("7"), "int", ("7",))) is None


@pytest.mark.parametrize(
    "number,want",
    [
        (20240229, D(2024, 2, 29)),
        (20230229, None),
        (20610701, None),
        (19000101, None),
        (0, None),
        (None, None),
    ],
)
def test_yyyymmdd(spark, number, want):
    column = F.lit(number).cast("bigint")
    assert one(spark, W.yyyymmdd_to_date(column, casts.OPEN_ENDED_DATES)) == want


def test_yyyymmdd_keeps_sentinels_unless_told(spark):
    assert one(spark, W.yyyymmdd_to_date(F.lit(20610701))) == D(2061, 7, 1)


@pytest.mark.parametrize(
    "text,want", [("Yes", True), ("No", False), ("yes", None), ("", None), (None, None)]
)
def test_yes_no(spark, text, want):
    assert one(spark, W.yes_no(F.lit(text).cast("string"))) is want


@pytest.mark.parametrize(
    "factor,want",
    [
        (None, "4. No financial data"),
        (1.0, "1. No penalty (factor >= 1.0)"),
        (0.9999, "2. Light penalty (0.99-1.0)"),
        (0.99, "2. Light penalty (0.99-1.0)"),
        (0.97, "3. Moderate penalty (0.97-0.99)"),
        (0.9699, "4. Heavy penalty (<0.97)"),
    ],
)
def test_penalty_band(spark, factor, want):
    assert one(spark, W.penalty_band(F.lit(factor).cast("double"))) == want


@pytest.mark.parametrize(
    "diagnosis,want",
    [
        ("Heart Failure", "READM-30-HF-HRRP"),
        ("Hip Replacement", "READM-30-HIP-KNEE-HRRP"),
        ("heart failure", None),
        ("Transplant", None),
        (None, None),
    ],
)
def test_measure_code(spark, diagnosis, want):
    assert one(spark, W.measure_code_of(F.lit(diagnosis).cast("string"))) == want


def test_percent(spark):
    assert one(spark, W.percent(F.lit(1), F.lit(0), 1)) is None
    assert one(spark, W.percent(F.lit(1), F.lit(3), 1)) == 33.3
    assert one(spark, W.percent(F.lit(1), F.lit(16), 1)) == 6.3
    assert one(spark, W.percent(F.lit(2), F.lit(3), 2)) == 66.67
