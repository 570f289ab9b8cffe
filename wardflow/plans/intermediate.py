"""Intermediate models: hospital rollup with attributes, flagged admissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.rules import (
    PLANNED_EXCLUSIONS,
    READMISSION_WINDOW_DAYS,
    exact_avg,
    is_readmission,
)
from wardflow.operators.history import ROWS_PER_SLICE, with_previous

CCN_LENGTH = 6

# Provider columns that hospitals and reports on them get.
PROVIDER_ATTRIBUTES = (
    "provider_ccn",
    "state_code",
    "bed_count",
    "case_mix_index",
    "medicaid_ratio",
    "hrr_adjustment_factor",
    "vbp_adjustment_factor",
    "operating_dsh_payment",
    "fiscal_year_begin_date",
    "census_division",
    "interns_to_beds_ratio",
)


def ccn_text(facility_id: Column, padded: bool) -> Column:
    """Facility number as it is compared with a provider's text number.

    Plain text loses the leading zeros of short numbers, so those hospitals find
    no provider record; ``padded`` restores the zeros.
    """
    text = facility_id.cast("string")
    if not padded:
        return text
    return F.when(F.length(text) < CCN_LENGTH, F.lpad(text, CCN_LENGTH, "0")).otherwise(text)


def facility_outcomes(metrics: DataFrame) -> DataFrame:
    """One row per facility, averages over the measures that have a ratio."""
    ratio = F.col("excess_readmission_ratio")
    return metrics.groupBy("facility_id").agg(
        exact_avg(ratio).alias("avg_excess_readmission_ratio"),
        F.sum("number_of_readmissions").alias("total_readmissions"),
        F.sum("number_of_discharges").alias("total_discharges"),
        F.countDistinct(F.when(ratio.isNotNull(), F.col("measure_name"))).alias(
            "measures_with_data"
        ),
    )


def int_providers_enriched(
    metrics: DataFrame, providers: DataFrame, admissions: DataFrame, *, ccn_padded: bool = False
) -> DataFrame:
    """Hospitals with published outcomes, with provider and hospital attributes.

    The rollup comes first, so both joins run on facility rows. Join strategies
    are left to Spark, which sees the sizes: the tables grow with the data.
    """
    outcomes = facility_outcomes(metrics).alias("h")
    joined = outcomes.join(
        providers.alias("p"), ccn_text(F.col("h.facility_id"), ccn_padded) == F.col("p.provider_ccn"), "left"
    ).join(admissions.alias("a"), F.col("h.facility_id") == F.col("a.facility_id"), "left")
    return joined.select(
        "h.facility_id",
        "a.facility_name",
        F.coalesce("p.state_code", "a.state_code").alias("state_code"),
        "a.address",
        "a.city",
        "a.hospital_type",
        "a.hospital_ownership",
        "a.has_emergency_services",
        "a.overall_rating",
        "p.bed_count",
        "p.case_mix_index",
        "p.medicaid_ratio",
        "p.hrr_adjustment_factor",
        "p.vbp_adjustment_factor",
        "p.operating_dsh_payment",
        "h.avg_excess_readmission_ratio",
        "h.total_readmissions",
        "h.total_discharges",
        "h.measures_with_data",
        "a.readm_better_count",
        "a.readm_same_count",
        "a.readm_worse_count",
        F.col("p.provider_ccn").isNull().alias("missing_provider_data"),
        F.col("a.facility_id").isNull().alias("missing_admissions_data"),
        "p.fiscal_year_begin_date",
    )


def int_readmissions_flagged(
    events: DataFrame,
    *,
    window_days: int = READMISSION_WINDOW_DAYS,
    exclusions: Sequence[str] = PLANNED_EXCLUSIONS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every admission with the patient's previous stay and the readmission flag.

    Previous means the row before by admission date, also where stays overlap.
    Same-day stays are taken in the order of their ids, shorter ids first, which
    is number order for plain numbers.
    """
    order = ["admission_date", F.length("admission_id"), "admission_id"]
    paired = with_previous(
        events,
        "patient_id",
        order,
        ["admission_id", "discharge_date"],
        rows_per_slice=rows_per_slice,
    )
    prior_discharge = F.col("previous.discharge_date")
    admission = F.col("admission_date")
    return paired.select(
        "admission_id",
        "patient_id",
        "facility_id",
        "admission_date",
        "discharge_date",
        "admission_type",
        "diagnosis_category",
        "length_of_stay",
        F.col("previous.admission_id").alias("prior_admission_id"),
        prior_discharge.alias("prior_discharge_date"),
        F.datediff(admission, prior_discharge).alias("days_since_prior_discharge"),
        is_readmission(
            prior_discharge,
            admission,
            F.col("admission_type"),
            F.col("diagnosis_category"),
            window_days=window_days,
            exclusions=exclusions,
        ).alias("is_readmission"),
    )
