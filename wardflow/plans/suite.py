"""The project's data tests, by kind and as one suite."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.rules import PLANNED_TYPE, READMISSION_WINDOW_DAYS
from wardflow.operators import checks
from wardflow.sources.reference_rows import MEASURE_CODES

# Accepted owner categories.
OWNER_VALUES = (
    "Government - Federal",
    "Government - Hospital District or Authority",
    "Government - Local",
    "Government - State",
    "Proprietary",
    "Voluntary non-profit - Church",
    "Voluntary non-profit - Other",
    "Voluntary non-profit - Private",
    "Tribal",
    "Physician",
)

# Which columns are tested, per model.
NOT_NULL_COLUMNS = {
    "stg_hrrp_metrics": ("facility_id", "measure_name"),
    "stg_admissions": ("facility_id", "facility_name", "state_code"),
    "stg_providers": ("provider_ccn", "state_code"),
    "dim_providers": ("facility_id", "facility_name"),
    "dim_conditions": ("measure_code", "condition_name"),
    "fct_readmissions": ("admission_id", "facility_id", "admission_date"),
}
UNIQUE_COLUMNS = {
    "stg_admissions": "facility_id",
    "stg_providers": "provider_ccn",
    "dim_providers": "facility_id",
    "dim_conditions": "measure_code",
    "fct_readmissions": "admission_id",
}
ACCEPTED_VALUES = {
    "stg_hrrp_metrics": ("measure_name", tuple(MEASURE_CODES)),
    "stg_admissions": ("hospital_ownership", OWNER_VALUES),
    "stg_providers": ("provider_type_code", ("00",)),
}
UNIQUE_COMBINATIONS = {"stg_hrrp_metrics": ("facility_id", "measure_name")}
RELATIONSHIPS = {
    "facility_id": ("dim_providers", "facility_id"),
    "measure_code": ("dim_conditions", "measure_code"),
}
WARN_ONLY = ("relationships_fct_readmissions_measure_code",)

STAGING_MODELS = ("stg_hrrp_metrics", "stg_admissions", "stg_providers")
MART_MODELS = ("dim_providers", "dim_conditions", "fct_readmissions")


@dataclass(frozen=True)
class Models:
    """The tested models. Hand in written tables where several tests follow."""

    stg_hrrp_metrics: DataFrame
    stg_admissions: DataFrame
    stg_providers: DataFrame
    dim_providers: DataFrame | None = None
    dim_conditions: DataFrame | None = None
    fct_readmissions: DataFrame | None = None


def not_null_tests(models: Models, names=STAGING_MODELS + MART_MODELS) -> DataFrame:
    return checks.all_of(
        [checks.not_null(getattr(models, m), m, NOT_NULL_COLUMNS[m]) for m in names]
    )


def unique_tests(models: Models, names=STAGING_MODELS + MART_MODELS) -> DataFrame:
    return checks.all_of(
        [
            checks.unique(getattr(models, m), m, UNIQUE_COLUMNS[m])
            for m in names
            if m in UNIQUE_COLUMNS
        ]
    )


def accepted_values_tests(models: Models) -> DataFrame:
    return checks.all_of(
        [
            checks.accepted_values(getattr(models, m), m, column, values)
            for m, (column, values) in ACCEPTED_VALUES.items()
        ]
    )


def unique_combination_tests(models: Models) -> DataFrame:
    return checks.all_of(
        [
            checks.unique_combination(getattr(models, m), m, columns)
            for m, columns in UNIQUE_COMBINATIONS.items()
        ]
    )


def relationships_tests(models: Models) -> DataFrame:
    return checks.all_of(
        [
            checks.relationships(
                models.fct_readmissions, "fct_readmissions", column, getattr(models, parent), key
            )
            for column, (parent, key) in RELATIONSHIPS.items()
        ]
    )


def _planned_cancer():
    return (
        F.col("is_readmission")
        & (F.col("diagnosis_category") == "Cancer Treatment")
        & (F.col("admission_type") == PLANNED_TYPE)
    )


def _beyond_window():
    return F.col("is_readmission") & (
        F.col("days_since_prior_discharge") > READMISSION_WINDOW_DAYS
    )


def no_planned_cancer_test(fact: DataFrame) -> DataFrame:
    """No planned cancer stay is flagged."""
    return checks.row_conditions(
        fact, {"fct_readmissions_no_planned_cancer_flagged": _planned_cancer()}
    )


def window_test(fact: DataFrame) -> DataFrame:
    """No flagged stay lies beyond the window."""
    return checks.row_conditions(fact, {"fct_readmissions_flags_within_30_days": _beyond_window()})


def row_tests(model: str) -> dict[str, Column]:
    """Tests of a model that look at single rows: when a row violates each."""
    conditions = {
        f"not_null_{model}_{name}": F.col(name).isNull() for name in NOT_NULL_COLUMNS.get(model, ())
    }
    if model == "fct_readmissions":
        conditions["fct_readmissions_no_planned_cancer_flagged"] = _planned_cancer()
        conditions["fct_readmissions_flags_within_30_days"] = _beyond_window()
    return conditions


def fact_summary(fact: DataFrame) -> DataFrame:
    """Admissions and violations of each row test per facility and measure.

    Sums of sums, so summaries of parts of the fact can be added up. All row tests of the
    fact and both relationships follow from it; it has six rows or so per facility.
    """
    counts = [F.count_if(broken).alias(name) for name, broken in row_tests("fct_readmissions").items()]
    return fact.groupBy(*RELATIONSHIPS).agg(F.count("*").alias("admissions"), *counts)


def fact_row_tests(summary: DataFrame) -> DataFrame:
    names = list(row_tests("fct_readmissions"))
    counts = summary.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])
    return counts.unpivot([], names, "check", "violations")


def fact_relationships(summary: DataFrame, models: Models) -> DataFrame:
    return checks.all_of(
        [
            checks.relationships(
                summary, "fct_readmissions", column, getattr(models, parent), key, weight="admissions"
            )
            for column, (parent, key) in RELATIONSHIPS.items()
        ]
    )


def with_status(results: DataFrame) -> DataFrame:
    severity = F.when(F.col("check").isin(*WARN_ONLY), "warn").otherwise("error")
    failed = F.when(F.col("severity") == "warn", "WARN").otherwise("FAIL")
    return results.withColumn("severity", severity).select(
        "check",
        "severity",
        "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise(failed).alias("status"),
    )


def staging_set_tests(models: Models) -> DataFrame:
    """Tests of staging that compare rows with each other or with a list."""
    return checks.all_of(
        [
            unique_tests(models, STAGING_MODELS),
            accepted_values_tests(models),
            unique_combination_tests(models),
        ]
    )


def staging_suite(models: Models) -> DataFrame:
    return with_status(
        not_null_tests(models, STAGING_MODELS).unionByName(staging_set_tests(models))
    )


def marts_suite(models: Models, summary: DataFrame | None = None) -> DataFrame:
    """``summary``: the fact's summary, where it is written already; it is read three times."""
    summary = fact_summary(models.fct_readmissions) if summary is None else summary
    return with_status(
        checks.all_of(
            [
                not_null_tests(models, ("dim_providers", "dim_conditions")),
                fact_row_tests(summary),
                unique_tests(models, MART_MODELS),
                fact_relationships(summary, models),
            ]
        )
    )


def dq_suite(models: Models, summary: DataFrame | None = None) -> DataFrame:
    """All 27 tests: check, severity, violations, status."""
    return staging_suite(models).unionByName(marts_suite(models, summary))
