import datetime as dt

import pytest
from fixtures import event_row, frame, hospital_row, metric_row, provider_row, sources
from pyspark.sql import functions as F

from wardflow.plans import intermediate, marts, staging
from wardflow.sources import condition_rows, provider_type_codes
from wardflow.sources.schemas import (
    ADMISSION_EVENTS,
    HOSPITAL_NAMES,
    METRIC_NAMES,
    PROVIDER_NAMES,
    RAW_HOSPITALS,
    RAW_METRICS,
    RAW_PROVIDERS,
)

D = dt.date


def test_metrics(spark):
    raw = frame(
        spark,
        [
            metric_row(1),
            metric_row(
                2,
                **{
                    "Number of Discharges": "Too Few to Report",
                    "Excess Readmission Ratio": "Not Available",
                    "Predicted Readmission Rate": "N/A",
                    "Expected Readmission Rate": "",
                    "Number of Readmissions": None,
                    "Start Date": "Not Available",
                    "End Date": "soon",
                },
            ),
        ],
        RAW_METRICS,
    )
    staged = staging.stg_hrrp_metrics(raw)
    assert staged.columns == list(METRIC_NAMES.values())
    types = dict(staged.dtypes)
    assert types["facility_id"] == "bigint" and types["number_of_discharges"] == "int"
    assert types["excess_readmission_ratio"] == "double"
    assert types["measurement_period_start"] == "date"
    good, empty = staged.orderBy("facility_id").collect()
    assert (good["number_of_discharges"], good["excess_readmission_ratio"]) == (100, 1.05)
    assert good["measurement_period_start"] == D(2021, 7, 1)
    assert good["measurement_period_end"] == D(2024, 6, 30)
    assert set(list(empty)[4:]) == {None}


def test_hospitals(spark):
    raw = frame(
        spark,
        [
            hospital_row("010001"),
            hospital_row("2", **{"Hospital Ownership": "Department of Defense"}),
            hospital_row("3", **{"Hospital Ownership": "Veterans Health Administration"}),
            hospital_row("4", **{"Hospital Ownership": None}),
            hospital_row(
                "5",
                **{
                    "Hospital Ownership": "Government - Federal",
                    "Emergency Services": "",
                    "Hospital overall rating": "Not Applicable",
                    "Count of READM Measures Better": "Too Few to Report",
                },
            ),
        ],
        RAW_HOSPITALS,
    )
    staged = staging.stg_admissions(raw)
    assert staged.columns == list(HOSPITAL_NAMES.values())
    first, federal = staged.orderBy(F.desc("facility_id")).collect()
    assert first["facility_id"] == 10001 and first["overall_rating"] == 4
    assert first["has_emergency_services"] is True and first["is_birthing_friendly"] is False
    assert first["mort_measures_count"] == 3 and first["mort_group_footnote"] == "3"
    assert federal["facility_id"] == 5 and federal["overall_rating"] is None
    assert federal["has_emergency_services"] is None and federal["readm_better_count"] is None


def test_providers(spark):
    raw = frame(
        spark,
        [
            provider_row("a", fiscalYearBeginDate=20191231),
            provider_row("b", fiscalYearBeginDate=20200101, terminationDate=19000101),
            provider_row("c", fiscalYearBeginDate=20251231, terminationDate=20240229),
            provider_row("d", fiscalYearBeginDate=20260101),
            provider_row("e", fiscalYearBeginDate=19000101),
            provider_row("f", providerType="04"),
            provider_row("g", providerType=None),
            provider_row("h", fiscalYearBeginDate=20230101, bedSize=1, lastUpdated="9"),
            provider_row("h", fiscalYearBeginDate=20240101, bedSize=2, exportDate=20240101),
            provider_row("h", fiscalYearBeginDate=20240101, bedSize=3, lastUpdated="a"),
            provider_row("h", fiscalYearBeginDate=20240101, bedSize=4, lastUpdated="b"),
        ],
        RAW_PROVIDERS,
    )
    staged = staging.stg_providers(raw, provider_type_codes(spark))
    assert staged.columns == list(PROVIDER_NAMES.values())
    got = {r["provider_ccn"]: r for r in staged.collect()}
    assert set(got) == {"b", "c", "h"}
    assert got["b"]["termination_date"] is None
    assert got["c"]["termination_date"] == D(2024, 2, 29)
    assert got["c"]["fiscal_year_begin_date"] == D(2025, 12, 31)
    assert got["h"]["bed_count"] == 4


def enriched(spark, ccn_padded=False, **inputs):
    raw = sources(spark, **inputs)
    return intermediate.int_providers_enriched(
        staging.stg_hrrp_metrics(raw.metrics),
        staging.stg_providers(raw.providers, raw.provider_types),
        staging.stg_admissions(raw.hospitals),
        ccn_padded=ccn_padded,
    )


CASES = {
    "metrics": [
        metric_row(100001, "READM-30-HF-HRRP", **{"Excess Readmission Ratio": "1.5"}),
        metric_row(100001, "READM-30-AMI-HRRP", **{"Excess Readmission Ratio": "0.5"}),
        metric_row(
            100001,
            "READM-30-PN-HRRP",
            **{"Excess Readmission Ratio": "Not Available", "Number of Readmissions": "N/A"},
        ),
        metric_row(10002, **{"Excess Readmission Ratio": "N/A", "Number of Discharges": ""}),
        metric_row(100003),
        metric_row(100004),
    ],
    "hospitals": [hospital_row("100001"), hospital_row("010002", State="CA"), hospital_row("100009")],
    "providers": [provider_row("100001"), provider_row("010002"), provider_row("100003")],
}


def test_enriched(spark):
    df = enriched(spark, **CASES)
    assert len(df.columns) == 25
    got = {r["facility_id"]: r for r in df.collect()}
    assert set(got) == {100001, 10002, 100003, 100004}
    full = got[100001]
    assert full["avg_excess_readmission_ratio"] == 1.0 and full["measures_with_data"] == 2
    assert (full["total_readmissions"], full["total_discharges"]) == (40, 300)
    assert full["state_code"] == "01" and full["bed_count"] == 120
    assert not full["missing_provider_data"] and not full["missing_admissions_data"]
    short = got[10002]  # plain text lost the zero, so no provider record is found
    assert short["missing_provider_data"] and not short["missing_admissions_data"]
    assert short["state_code"] == "CA" and short["avg_excess_readmission_ratio"] is None
    assert short["measures_with_data"] == 0 and short["total_discharges"] is None
    assert got[100003]["missing_admissions_data"] and not got[100003]["missing_provider_data"]
    assert got[100004]["missing_admissions_data"] and got[100004]["missing_provider_data"]
    assert got[100004]["state_code"] is None


def test_enriched_with_padded_numbers(spark):
    got = {r["facility_id"]: r for r in enriched(spark, ccn_padded=True, **CASES).collect()}
    assert not got[10002]["missing_provider_data"]
    assert got[10002]["state_code"] == "01"


EVENTS = [
    event_row(1),
    event_row(2, admitted=D(2026, 1, 20)),
    event_row(3, admitted=D(2026, 2, 1), days=30),
    event_row(4, admitted=D(2026, 2, 5), days=2),  # inside the stay before
    event_row(5, admitted=D(2026, 2, 10), kind="Planned", diagnosis="Transplant"),
    event_row(6, admitted=D(2026, 2, 20), kind=None, diagnosis="Rehabilitation"),
    event_row(7, "P2", D(2026, 1, 1), diagnosis="Surgical Complication"),
    event_row(8, "P2", D(2026, 1, 1), diagnosis=None),  # same day
    event_row(9, "P3", None),
    event_row(10, "P3", D(2026, 5, 1)),
    event_row(11, None, D(2026, 5, 1)),
    event_row(12, None, D(2026, 6, 4)),
]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 2])
def test_flagged(spark, rows_per_slice):
    events = spark.createDataFrame(EVENTS, ADMISSION_EVENTS)
    df = intermediate.int_readmissions_flagged(events, rows_per_slice=rows_per_slice)
    assert len(df.columns) == 12
    got = {
        r["admission_id"]: (
            r["prior_admission_id"],
            r["days_since_prior_discharge"],
            r["is_readmission"],
        )
        for r in df.collect()
    }
    assert got == {
        "A001": (None, None, False),
        "A002": ("A001", 15, True),
        "A003": ("A002", 8, True),
        "A004": ("A003", -26, False),
        "A005": ("A004", 3, False),
        "A006": ("A005", 6, None),
        "A007": (None, None, False),
        "A008": ("A007", -4, False),
        "A009": (None, None, False),
        "A010": ("A009", None, False),
        "A011": (None, None, False),
        "A012": ("A011", 30, True),
    }


def test_flagged_with_the_shape_of_the_published_events(spark):
    """50 patients with two stays each: 38 returns count, 6 are planned, 6 too late."""
    planned = [12, 17, 20, 23, 29, 30]
    late = [31, 31, 31, 32, 34, 34]
    counted = [30] * 19 + list(range(1, 20))
    data, number = [], 0
    for patient, gap in enumerate(planned + late + counted):
        first = D(2026, 1, 5)
        back = first + dt.timedelta(4 + gap)
        excluded = gap in planned and patient < 6
        data.append(event_row(number, f"P{patient}", first))
        data.append(
            event_row(
                number + 1,
                f"P{patient}",
                back,
                kind="Planned" if excluded else "Emergency",
                diagnosis="Cancer Treatment" if excluded else "Heart Failure",
            )
        )
        number += 2
    flagged = intermediate.int_readmissions_flagged(spark.createDataFrame(data, ADMISSION_EVENTS))
    got = {r["is_readmission"]: r["count"] for r in flagged.groupBy("is_readmission").count().collect()}
    assert got == {True: 38, False: 62}


def test_fact_and_dimensions(spark):
    events = spark.createDataFrame(EVENTS, ADMISSION_EVENTS)
    fact = marts.fct_readmissions(intermediate.int_readmissions_flagged(events))
    assert len(fact.columns) == 13 and fact.count() == len(EVENTS)
    codes = {r["admission_id"]: r["measure_code"] for r in fact.collect()}
    assert codes["A001"] == "READM-30-AMI-HRRP" and codes["A005"] is None
    assert marts.dim_conditions(spark).count() == 6
    assert condition_rows(spark).agg(F.sum("sort_order")).first()[0] == 21
    dimension = marts.dim_providers(enriched(spark, **CASES))
    assert len(dimension.columns) == 18 and dimension.count() == 4
    assert provider_type_codes(spark).where("is_hrrp_eligible").count() == 1
