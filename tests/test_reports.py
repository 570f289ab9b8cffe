import datetime as dt

import pytest
from fixtures import event_row, hospital_row, metric_row, provider_row, sources
from pyspark.sql import functions as F

from wardflow.functions.rules import exact_avg
from wardflow.plans import audits, intermediate, marts, reports, staging, suite
from wardflow.plans.build import ChecksFailed, require, results_of

D = dt.date


def models(spark, **inputs):
    raw = sources(spark, **inputs)
    metrics = staging.stg_hrrp_metrics(raw.metrics)
    providers = staging.stg_providers(raw.providers, raw.provider_types)
    hospitals = staging.stg_admissions(raw.hospitals)
    enriched = intermediate.int_providers_enriched(metrics, providers, hospitals)
    fact = marts.fct_readmissions(intermediate.int_readmissions_flagged(raw.events))
    return raw, suite.Models(
        stg_hrrp_metrics=metrics,
        stg_admissions=hospitals,
        stg_providers=providers,
        dim_providers=marts.dim_providers(enriched),
        dim_conditions=marts.dim_conditions(spark),
        fct_readmissions=fact,
    )


INPUTS = {
    "metrics": [
        metric_row(100001, **{"Excess Readmission Ratio": "1.2"}),
        metric_row(100002, **{"Excess Readmission Ratio": "0.9", "Number of Readmissions": "few"}),
        metric_row(100003, **{"Excess Readmission Ratio": "N/A"}),
    ],
    "hospitals": [
        hospital_row("100001"),
        hospital_row("100002", **{"Hospital overall rating": "Not Available"}),
        hospital_row("100003", **{"Hospital Ownership": "Tribal", "Hospital overall rating": ""}),
    ],
    "providers": [provider_row("100001", hrrAdjustment=0.96), provider_row("100002", stateCode="02")],
    "events": [
        event_row(1, "P1", D(2026, 1, 1), facility=100001),
        event_row(2, "P1", D(2026, 1, 10), facility=100001),
        event_row(3, "P1", D(2026, 1, 20), facility=100002, diagnosis="COPD"),
        event_row(4, "P2", D(2026, 1, 1), facility=999999, diagnosis="COPD"),
        event_row(5, "P3", D(2026, 1, 1), facility=100001, diagnosis="Transplant"),
    ],
}


def table(df):
    return [tuple(row) for row in df.collect()]


def test_penalty_bands(spark):
    _, m = models(spark, **INPUTS)
    assert table(reports.penalty_bands(m.dim_providers)) == [
        ("3. Moderate penalty (0.97-0.99)", 1, 0.985),
        ("4. Heavy penalty (<0.97)", 1, 0.96),
        ("4. No financial data", 1, None),
    ]


def test_rate_by_condition_and_state(spark):
    _, m = models(spark, **INPUTS)
    report = reports.readmission_rate_by_condition_state(
        m.fct_readmissions, m.dim_conditions, m.dim_providers
    )
    assert table(report) == [
        ("COPD", "02", 1, 1, 100.0),
        ("Heart Attack (AMI)", "01", 2, 1, 50.0),
        ("COPD", None, 1, 0, 0.0),
    ]


def test_providers_above_expected(spark):
    _, m = models(spark, **INPUTS)
    assert table(reports.providers_above_expected(m.dim_providers, m.stg_providers)) == [
        (100001, "Hospital 100001", "01", "6", "Proprietary", 120, True, 1.2, 1)
    ]


def test_rate_by_diagnosis(spark):
    _, m = models(spark, **INPUTS)
    assert sorted(table(reports.readmission_rate_by_diagnosis(m.fct_readmissions))) == [
        ("AMI", 2, 1, 50.0),
        ("COPD", 2, 1, 50.0),
        ("Transplant", 1, 0, 0.0),
    ]


def test_simulated_vs_published(spark):
    _, m = models(spark, **INPUTS)
    report = table(
        reports.simulated_vs_published(m.fct_readmissions, m.stg_hrrp_metrics, m.dim_conditions)
    )
    assert [row[3] for row in report] == [1, 2, 3, 4, 5, 6]
    assert report[0][4:] == (2, 1, 50.0, None, None)
    assert report[1][4:] == (None, None, None, 2, 1.05)


def test_raw_profile(spark):
    raw, _ = models(spark, **INPUTS)
    assert dict(table(audits.raw_profile(raw.hospitals))) == {
        "Total rows": "3",
        "Distinct facility_ids": "3",
        "Hospital ownership categories (raw)": "2",
        'Rows with overall_rating = "Not Available"': "1",
        "Rows with overall_rating = numeric": "1",
        "Distinct hospital_ownership values": "Proprietary, Tribal",
    }


def test_audits(spark):
    raw, m = models(spark, **INPUTS)
    enriched = intermediate.int_providers_enriched(
        m.stg_hrrp_metrics, m.stg_providers, m.stg_admissions
    )
    assert table(audits.audit_missing_providers(enriched))[0][1:] == (3, 1, 33.3)
    assert table(audits.audit_missing_admissions(enriched))[0][1:] == (3, 0, 0.0)
    assert table(
        audits.audit_ref_integrity(m.fct_readmissions, m.dim_conditions, m.dim_providers)
    )[0][1:] == (5, 1, 1, 40.0)
    lost = {row[1]: row[2] for row in table(audits.cast_losses(raw.metrics, raw.hospitals))}
    assert lost["Number of Readmissions"] == 1 and sum(lost.values()) == 1


def test_audits_on_empty_tables(spark):
    _, m = models(spark)
    fact = m.fct_readmissions.where("false")
    row = table(audits.audit_ref_integrity(fact, m.dim_conditions, m.dim_providers))[0]
    assert row[1:] == (0, None, None, None)
    gate = table(audits.dq_gate(m.stg_admissions.where("false"), m.stg_hrrp_metrics.where("false")))
    assert ("accepted_values_measure_name", None, "FAIL") in gate


def test_ccn_format(spark):
    _, m = models(
        spark,
        providers=[provider_row("010001"), provider_row("100002 "), provider_row("12345")],
    )
    assert table(audits.audit_ccn_format(m.stg_providers))[0][1:] == (3, 2, 1, 1)


def test_dq_gate(spark):
    _, m = models(
        spark,
        metrics=[metric_row(1), metric_row(1), metric_row(2, "READM-30-OTHER")],
        hospitals=[hospital_row("1"), hospital_row("2")],
    )
    assert sorted(table(audits.dq_gate(m.stg_admissions, m.stg_hrrp_metrics))) == [
        ("accepted_values_measure_name", 1, "FAIL"),
        ("unique_combination_facility_measure", 1, "FAIL"),
        ("unique_facility_id_in_stg_admissions", 0, "PASS"),
    ]


def test_suite_passes_on_clean_data(spark):
    _, m = models(spark)
    results = suite.dq_suite(m).collect()
    assert len(results) == 27 and len({r["check"] for r in results}) == 27
    assert {r["status"] for r in results} == {"PASS"}
    assert [r["check"] for r in results if r["severity"] == "warn"] == [
        "relationships_fct_readmissions_measure_code"
    ]


def test_suite_finds_seeded_defects(spark):
    _, m = models(
        spark,
        metrics=[
            metric_row(None),
            metric_row(1, None),
            metric_row(2, "READM-30-OTHER"),
            metric_row(3),
            metric_row(3),
        ],
        hospitals=[
            hospital_row("x"),
            hospital_row("3"),
            hospital_row("3", **{"Facility Name": None, "State": None}),
            hospital_row("4", **{"Hospital Ownership": "Martian"}),
        ],
        providers=[provider_row(None, stateCode=None)],
        events=[
            event_row(1, facility=77),
            event_row(1, facility=None),
            event_row(2, "P2", None, facility=77),
        ],
    )
    broken = m.fct_readmissions
    # What the rule never yields, to see the two rule tests fail.
    broken = broken.unionByName(
        broken.limit(1)
        .withColumn("admission_id", F.lit(None).cast("string"))
        .withColumn("is_readmission", F.lit(True))
        .withColumn("admission_type", F.lit("Planned"))
        .withColumn("diagnosis_category", F.lit("Cancer Treatment"))
        .withColumn("days_since_prior_discharge", F.lit(31))
        .withColumn("measure_code", F.lit("READM-30-OTHER"))
    )
    providers = m.stg_providers
    providers = providers.unionByName(
        providers.withColumns(
            {"provider_ccn": F.lit("z"), "provider_type_code": F.lit("04")}
        )
    )
    providers = providers.unionByName(providers.where("provider_ccn = 'z'"))
    conditions = m.dim_conditions.unionByName(
        m.dim_conditions.where("sort_order = 1").withColumn(
            "condition_name", F.lit(None).cast("string")
        )
    ).unionByName(
        m.dim_conditions.where("sort_order = 2").withColumn(
            "measure_code", F.lit(None).cast("string")
        )
    )
    seeded = suite.Models(
        stg_hrrp_metrics=m.stg_hrrp_metrics,
        stg_admissions=m.stg_admissions,
        stg_providers=providers,
        dim_providers=m.dim_providers,
        dim_conditions=conditions,
        fct_readmissions=broken,
    )
    results = suite.dq_suite(seeded)
    got = {r["check"]: (r["status"], r["violations"]) for r in results.collect()}
    assert [name for name, (status, _) in got.items() if status == "PASS"] == []
    assert got["relationships_fct_readmissions_measure_code"] == ("WARN", 1)
    assert got["unique_dim_providers_facility_id"] == ("FAIL", 1)
    with pytest.raises(ChecksFailed) as failure:
        require(results_of(results), "all")
    assert len(failure.value.failed) == 26


def test_average_is_exact(spark):
    """An average just above 1 counts as above 1, however rows are dealt out."""
    ratios = ["1.0000001", "1.0000002", "1.0", "0.1", "0.2", "0.3", "1.0000001"]
    metrics = [metric_row(1, f"M{i}", **{"Excess Readmission Ratio": r}) for i, r in enumerate(ratios[:3])]
    metrics += [metric_row(2, f"M{i}", **{"Excess Readmission Ratio": r}) for i, r in enumerate(["1.0000001", "0.9999999"])]
    metrics += [metric_row(3, f"M{i}", **{"Excess Readmission Ratio": r}) for i, r in enumerate(["1.0000001"] * 3)]
    _, m = models(spark, metrics=metrics)
    found = reports.providers_above_expected(m.dim_providers, m.stg_providers)
    got = {r.facility_id: r.avg_excess_readmission_ratio for r in found.collect()}
    assert got == {1: 1.0000001, 3: 1.0000001}
    values = spark.range(20_000).selectExpr("id", "(id * 7919 % 10007) / 3000 AS v")
    averages = {values.repartition(n).agg(exact_avg(F.col("v"))).first()[0] for n in (1, 3, 8, 50)}
    assert len(averages) == 1
    assert spark.range(1).selectExpr("CAST(NULL AS DOUBLE) AS v").agg(exact_avg(F.col("v"))).first()[0] is None


def test_suite_reads_the_fact_for_its_summary_only(spark):
    _, m = models(spark)
    summary = suite.fact_summary(m.fct_readmissions)
    kept = spark.createDataFrame(summary.collect(), summary.schema)
    checks_of_summary = {r.check: r.violations for r in suite.dq_suite(m, kept).collect()}
    assert checks_of_summary == {r.check: r.violations for r in suite.dq_suite(m).collect()}
    assert len(checks_of_summary) == 27
    # Summaries of parts add up to the summary of the whole.
    parts = m.fct_readmissions.where("admission_id < 'A002'"), m.fct_readmissions.where("admission_id >= 'A002'")
    both = suite.fact_summary(parts[0]).unionByName(suite.fact_summary(parts[1]))
    assert sorted(map(tuple, suite.fact_row_tests(both).collect())) == sorted(map(tuple, suite.fact_row_tests(summary).collect()))
