"""Marts: two dimensions and one fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.rules import measure_code_of
from wardflow.sources.reference_rows import condition_rows


def dim_providers(enriched: DataFrame) -> DataFrame:
    """One row per hospital, columns only."""
    return enriched.select(
        "facility_id",
        "facility_name",
        "state_code",
        "address",
        "city",
        "hospital_type",
        "hospital_ownership",
        "has_emergency_services",
        "bed_count",
        "overall_rating",
        "avg_excess_readmission_ratio",
        "measures_with_data",
        "hrr_adjustment_factor",
        "vbp_adjustment_factor",
        "case_mix_index",
        "medicaid_ratio",
        "missing_provider_data",
        "missing_admissions_data",
    )


def dim_conditions(spark: SparkSession) -> DataFrame:
    """One row per published measure."""
    return condition_rows(spark)


def fct_readmissions(flagged: DataFrame) -> DataFrame:
    """One row per admission, with the keys of both dimensions."""
    return flagged.select(
        "admission_id",
        "patient_id",
        "facility_id",
        measure_code_of(F.col("diagnosis_category")).alias("measure_code"),
        "admission_date",
        "discharge_date",
        "prior_admission_id",
        "prior_discharge_date",
        "length_of_stay",
        "days_since_prior_discharge",
        "is_readmission",
        "admission_type",
        "diagnosis_category",
    )


def fct_readmissions_keys(events: DataFrame) -> DataFrame:
    """Columns of the fact that need no history, for checks that read keys only.

    The same rows as ``fct_readmissions`` without a shuffle or a count of histories.
    """
    return events.select(
        "admission_id",
        "patient_id",
        "facility_id",
        measure_code_of(F.col("diagnosis_category")).alias("measure_code"),
        "admission_date",
        "discharge_date",
        "length_of_stay",
        "admission_type",
        "diagnosis_category",
    )
