"""Reports over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.rules import penalty_band, percent, settled_avg
from wardflow.plans.intermediate import ccn_text


def _flagged_count(column: str = "is_readmission") -> Column:
    """Rows where the flag is TRUE; unknown flags count as no."""
    return F.sum(F.when(F.col(column), 1).otherwise(0))


def penalty_bands(providers_dim: DataFrame) -> DataFrame:
    """Hospitals per payment adjustment band."""
    factor = F.col("hrr_adjustment_factor")
    return (
        providers_dim.groupBy(penalty_band(factor).alias("penalty_band"))
        .agg(
            F.count("*").alias("hospital_count"),
            settled_avg(factor, 4).alias("avg_adjustment_factor"),
        )
        .orderBy("penalty_band")
    )


def readmission_rate_by_condition_state(
    fact: DataFrame, conditions_dim: DataFrame, providers_dim: DataFrame
) -> DataFrame:
    """Readmission rate per published condition and hospital state.

    Admissions are counted per facility and measure before any join: both keys
    are all the dimensions need, and a facility holding a large share of the
    admissions is then a handful of rows.
    """
    counted = (
        fact.where(F.col("measure_code").isNotNull())
        .groupBy("facility_id", "measure_code")
        .agg(F.count("*").alias("admissions"), _flagged_count().alias("readmissions"))
    )
    states = providers_dim.select("facility_id", F.col("state_code").alias("state"))
    admissions, readmissions = F.sum("admissions"), F.sum("readmissions")
    return (
        counted.join(conditions_dim.select("measure_code", "condition_name"), "measure_code")
        .where(F.col("condition_name").isNotNull())
        .join(states, "facility_id", "left")
        .groupBy("condition_name", "state")
        .agg(
            admissions.alias("total_admissions"),
            readmissions.alias("readmission_count"),
            percent(readmissions, admissions, 1).alias("readmission_rate_pct"),
        )
        .orderBy(F.desc("readmission_rate_pct"), "condition_name", "state")
    )


def providers_above_expected(
    providers_dim: DataFrame, providers: DataFrame, *, threshold: float = 1.0, ccn_padded: bool = False
) -> DataFrame:
    """Hospitals whose average excess ratio is above ``threshold``, with attributes."""
    extra = providers.select("provider_ccn", "census_division", "interns_to_beds_ratio")
    above = providers_dim.where(F.col("avg_excess_readmission_ratio") > threshold)
    return above.join(
        extra, ccn_text(F.col("facility_id"), ccn_padded) == F.col("provider_ccn"), "left"
    ).select(
        "facility_id",
        "facility_name",
        "state_code",
        "census_division",
        "hospital_ownership",
        "bed_count",
        (F.col("interns_to_beds_ratio") > 0).alias("is_teaching"),
        "avg_excess_readmission_ratio",
        "measures_with_data",
    )


def readmission_rate_by_diagnosis(fact: DataFrame) -> DataFrame:
    """Readmission rate per diagnosis category."""
    admissions, readmissions = F.count("*"), _flagged_count()
    return fact.groupBy("diagnosis_category").agg(
        admissions.alias("total_admissions"),
        readmissions.alias("readmission_count"),
        percent(readmissions, admissions, 1).alias("readmission_rate_pct"),
    )


def simulated_vs_published(
    fact: DataFrame, metrics: DataFrame, conditions_dim: DataFrame
) -> DataFrame:
    """Rates in the admission events next to the published ratios, per condition."""
    simulated = (
        fact.where(F.col("measure_code").isNotNull())
        .groupBy("measure_code")
        .agg(
            F.count("*").alias("simulated_admissions"),
            _flagged_count().alias("simulated_readmissions"),
        )
    )
    published = metrics.groupBy(F.col("measure_name").alias("measure_code")).agg(
        F.count("excess_readmission_ratio").alias("facilities_with_ratio"),
        settled_avg(F.col("excess_readmission_ratio"), 4).alias("avg_excess_readmission_ratio"),
    )
    return (
        conditions_dim.join(simulated, "measure_code", "left")
        .join(published, "measure_code", "left")
        .select(
            "measure_code",
            "condition_name",
            "condition_category",
            "sort_order",
            "simulated_admissions",
            "simulated_readmissions",
            percent(
                F.col("simulated_readmissions"), F.col("simulated_admissions"), 1
            ).alias("simulated_rate_pct"),
            "facilities_with_ratio",
            "avg_excess_readmission_ratio",
        )
        .orderBy("sort_order")
    )
