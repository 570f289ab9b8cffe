"""Registered queries: the package applied to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import functions as W
from wardflow.functions.casts import OPEN_ENDED_DATES
from wardflow.plans import audits, intermediate, marts, reports, staging, suite
from wardflow.session import materialize
from wardflow.sources import reference_rows
from wardflow.sources.sample_inputs import SampleInputs
from wardflow.sources.readers import conform
from wardflow.sources.schemas import ADMISSION_EVENTS, PROVIDER_DATES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Frames], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Frames(spark, folder))

    QUERIES[build.__name__] = run
    return build


class Frames:
    """The models over one folder of tables, lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.raw = SampleInputs(spark, folder)

    @cached_property
    def metrics(self) -> DataFrame:
        return staging.stg_hrrp_metrics(self.raw.metrics)

    @cached_property
    def hospitals(self) -> DataFrame:
        return staging.stg_admissions(self.raw.hospitals)

    @cached_property
    def providers(self) -> DataFrame:
        return staging.stg_providers(self.raw.providers, self.raw.provider_types)

    @cached_property
    def enriched(self) -> DataFrame:
        return intermediate.int_providers_enriched(self.metrics, self.providers, self.hospitals)

    @cached_property
    def flagged(self) -> DataFrame:
        return intermediate.int_readmissions_flagged(self.raw.events)

    @cached_property
    def dim_providers(self) -> DataFrame:
        return marts.dim_providers(self.enriched)

    @cached_property
    def dim_conditions(self) -> DataFrame:
        return marts.dim_conditions(self.spark)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fct_readmissions(self.flagged)

    @cached_property
    def fact_keys(self) -> DataFrame:
        return marts.fct_readmissions_keys(self.raw.events)

    @cached_property
    def key_models(self) -> suite.Models:
        """The models, for tests that read no flag."""
        return replace(self.models_without_fact, fct_readmissions=self.fact_keys)

    @cached_property
    def models(self) -> suite.Models:
        return replace(self.models_without_fact, fct_readmissions=self.fact)

    @cached_property
    def models_without_fact(self) -> suite.Models:
        return suite.Models(
            stg_hrrp_metrics=self.metrics,
            stg_admissions=self.hospitals,
            stg_providers=self.providers,
            dim_providers=self.dim_providers,
            dim_conditions=self.dim_conditions,
        )


# ---- models ----


@query
def admission_events(f: Frames) -> DataFrame:
    return f.raw.events


@query
def provider_type_codes(f: Frames) -> DataFrame:
    """Provider type lookup with the number of raw records per type."""
    records = f.raw.providers.groupBy(F.col("providerType").alias("provider_type_code")).agg(
        F.count("*").alias("n")
    )
    return (
        reference_rows.provider_type_codes(f.spark)
        .join(records, "provider_type_code", "left")
        .withColumn("raw_records", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@query
def stg_hrrp_metrics(f: Frames) -> DataFrame:
    return f.metrics


@query
def stg_admissions(f: Frames) -> DataFrame:
    return f.hospitals


@query
def stg_providers(f: Frames) -> DataFrame:
    return f.providers


@query
def int_providers_enriched(f: Frames) -> DataFrame:
    return f.enriched


@query
def int_providers_enriched_padded(f: Frames) -> DataFrame:
    """Provider join on zero-padded numbers."""
    return intermediate.int_providers_enriched(
        f.metrics, f.providers, f.hospitals, ccn_padded=True
    )


@query
def int_readmissions_flagged(f: Frames) -> DataFrame:
    return f.flagged


@query
def int_readmissions_flagged_sliced(f: Frames) -> DataFrame:
    """The same by the way that long histories take: patients with over four stays are cut."""
    return intermediate.int_readmissions_flagged(f.raw.events, rows_per_slice=4)


@query
def dim_providers(f: Frames) -> DataFrame:
    return f.dim_providers


@query
def dim_conditions(f: Frames) -> DataFrame:
    """Condition dimension with the number of published rows per measure."""
    published = f.metrics.groupBy(F.col("measure_name").alias("measure_code")).agg(
        F.count("*").alias("n")
    )
    return (
        f.dim_conditions.join(published, "measure_code", "left")
        .withColumn("published_rows", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@query
def fct_readmissions(f: Frames) -> DataFrame:
    return f.fact


# ---- rules and casts ----


@query
def is_readmission(f: Frames) -> DataFrame:
    """The rule alone, each admission paired with an earlier discharge.

    The id sets the gap, from overlapping to beyond the window, and which of
    the four inputs is unknown.
    """
    number = F.col("admission_id").cast("bigint")
    gap = (number % 41 - 4).cast("int")
    cases = f.raw.events.select(
        "admission_id",
        F.when(number % 11 != 0, F.date_sub("admission_date", gap)).alias("prior_discharge"),
        F.when(number % 13 != 0, F.col("admission_date")).alias("admission_date"),
        F.when(number % 7 != 0, F.col("admission_type")).alias("admission_type"),
        F.when(number % 9 != 0, F.col("diagnosis_category")).alias("diagnosis_category"),
    )
    rule = [
        F.col(c)
        for c in ("prior_discharge", "admission_date", "admission_type", "diagnosis_category")
    ]
    return cases.select(
        "admission_id",
        W.is_readmission(*rule).alias("is_readmission"),
        W.is_readmission(*rule, window_days=7, exclusions=("Transplant",)).alias(
            "is_readmission_7_days"
        ),
    )


@query
def safe_cast_int(f: Frames) -> DataFrame:
    text = F.col("`Count of Facility READM Measures`")
    return f.raw.hospitals.select(
        F.col("`Facility ID`").alias("ccn"),
        text.alias("text"),
        W.safe_cast_int(text).alias("value"),
    )


@query
def safe_cast_double(f: Frames) -> DataFrame:
    text = F.col("`Predicted Readmission Rate`")
    return f.raw.metrics.select(
        F.col("`Facility ID`").alias("facility_id"),
        F.col("`Measure Name`").alias("measure_name"),
        text.alias("text"),
        W.safe_cast_double(text).alias("value"),
    )


@query
def safe_cast_date(f: Frames) -> DataFrame:
    text = F.col("`Start Date`")
    return f.raw.metrics.select(
        F.col("`Facility ID`").alias("facility_id"),
        F.col("`Measure Name`").alias("measure_name"),
        text.alias("text"),
        W.safe_cast_date(text).alias("value"),
    )


@query
def yyyymmdd_dates(f: Frames) -> DataFrame:
    """Provider records per set of converted dates."""
    days = {
        name: W.yyyymmdd_to_date(name, OPEN_ENDED_DATES if name == "terminationDate" else ())
        for name in PROVIDER_DATES
    }
    return f.raw.providers.groupBy(*[day.alias(name) for name, day in days.items()]).agg(
        F.count("*").alias("records")
    )


# ---- reports ----


@query
def penalty_bands(f: Frames) -> DataFrame:
    return reports.penalty_bands(f.dim_providers)


@query
def readmission_rate_by_condition_state(f: Frames) -> DataFrame:
    return reports.readmission_rate_by_condition_state(f.fact, f.dim_conditions, f.dim_providers)


@query
def providers_above_expected(f: Frames) -> DataFrame:
    f.providers = materialize(f.providers.select(*intermediate.PROVIDER_ATTRIBUTES), "stg_providers")
    return reports.providers_above_expected(f.dim_providers, f.providers)


@query
def readmission_rate_by_diagnosis(f: Frames) -> DataFrame:
    return reports.readmission_rate_by_diagnosis(f.fact)


@query
def simulated_vs_published(f: Frames) -> DataFrame:
    return reports.simulated_vs_published(f.fact, f.metrics, f.dim_conditions)


# ---- audits and data tests ----


@query
def raw_profile(f: Frames) -> DataFrame:
    return audits.raw_profile(f.raw.hospitals)


@query
def dq_gate(f: Frames) -> DataFrame:
    return audits.dq_gate(f.hospitals, f.metrics)


@query
def audit_missing_providers(f: Frames) -> DataFrame:
    return audits.audit_missing_providers(f.enriched)


@query
def audit_missing_admissions(f: Frames) -> DataFrame:
    return audits.audit_missing_admissions(f.enriched)


@query
def audit_ccn_format(f: Frames) -> DataFrame:
    return audits.audit_ccn_format(f.providers)


@query
def audit_ref_integrity(f: Frames) -> DataFrame:
    return audits.audit_ref_integrity(f.fact_keys, f.dim_conditions, f.dim_providers)


@query
def audit_cast_losses(f: Frames) -> DataFrame:
    """Losses of staging casts, and of bringing uploaded admissions to their contract."""
    return audits.cast_losses(f.raw.metrics, f.raw.hospitals, f.raw.providers).unionByName(
        audits.conform_losses(f.raw.uploaded_events, "raw_readmissions_events", ADMISSION_EVENTS)
    )


@query
def conformed_events(f: Frames) -> DataFrame:
    """Admissions uploaded as texts, brought to their contract."""
    return conform(f.raw.uploaded_events, ADMISSION_EVENTS)


@query
def test_not_null(f: Frames) -> DataFrame:
    f.providers = materialize(f.providers.select(*intermediate.PROVIDER_ATTRIBUTES), "stg_providers")
    return suite.not_null_tests(f.key_models)


@query
def test_unique(f: Frames) -> DataFrame:
    return suite.unique_tests(f.key_models)


@query
def test_accepted_values(f: Frames) -> DataFrame:
    return suite.accepted_values_tests(f.key_models)


@query
def test_relationships(f: Frames) -> DataFrame:
    return suite.relationships_tests(f.key_models)


@query
def test_unique_combination(f: Frames) -> DataFrame:
    return suite.unique_combination_tests(f.key_models)


@query
def test_no_planned_cancer(f: Frames) -> DataFrame:
    return suite.no_planned_cancer_test(f.fact)


@query
def test_window_30(f: Frames) -> DataFrame:
    return suite.window_test(f.fact)


@query
def dq_suite(f: Frames) -> DataFrame:
    """All tests. Models that several tests read are written once first; the fact is read
    for its summary and, keys only, for its unique ids."""
    f.metrics = materialize(f.metrics, "stg_hrrp_metrics")
    f.providers = materialize(f.providers, "stg_providers")
    f.enriched = materialize(f.enriched, "int_providers_enriched")
    summary = materialize(suite.fact_summary(f.fact), "fact_summary")
    return suite.dq_suite(f.key_models, summary)
