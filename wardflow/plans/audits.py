"""Profiling and audit reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions import casts
from wardflow.functions.rules import percent
from wardflow.plans.staging import HOSPITAL_CASTS, METRIC_CASTS, raw
from wardflow.sources.readers import Sources, conform_sql
from wardflow.sources.reference_rows import MEASURE_CODES
from wardflow.sources.schemas import PROVIDER_DATES


def _rows_where(condition: Column) -> Column:
    """Rows meeting the condition; NULL on an empty table, as a plain sum is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def raw_profile(raw_hospitals: DataFrame) -> DataFrame:
    """Six facts about the raw hospital table, as text.

    Rows are counted per owner first, which leaves a short table from which five
    facts follow. Distinct facilities need their own column and their own pass.
    """
    rating = raw("Hospital overall rating")
    by_owner = raw_hospitals.groupBy(raw("Hospital Ownership").alias("owner")).agg(
        F.count("*").alias("n"),
        _rows_where(rating == "Not Available").alias("unrated"),
        _rows_where(rating.rlike("^[0-9]+$")).alias("rated"),
    )
    # Names of the metrics.
    facts = by_owner.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("string").alias("Total rows"),
        F.count("owner").cast("string").alias("Hospital ownership categories (raw)"),
        F.sum("unrated").cast("string").alias('Rows with overall_rating = "Not Available"'),
        F.sum("rated").cast("string").alias("Rows with overall_rating = numeric"),
        F.array_join(F.array_sort(F.collect_list("owner")), ", ").alias(
            "Distinct hospital_ownership values"
        ),
    )
    facilities = raw_hospitals.agg(F.countDistinct(raw("Facility ID")).alias("n")).select(
        F.lit("Distinct facility_ids").alias("metric"),
        F.col("n").cast("string").alias("value"),
    )
    return facts.unpivot([], facts.columns, "metric", "value").unionByName(facilities)


def dq_gate(admissions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Three gate checks with PASS or FAIL; each table is read once."""
    distinct_pairs = F.countDistinct(
        F.concat(F.col("facility_id").cast("string"), F.lit("|"), F.col("measure_name"))
    )
    # Names of the gate checks.
    per_hospital = admissions.agg(
        (F.count("*") - F.countDistinct("facility_id")).alias(
            "unique_facility_id_in_stg_admissions"
        )
    )
    per_metric = metrics.agg(
        _rows_where(~F.col("measure_name").isin(*MEASURE_CODES)).alias(
            "accepted_values_measure_name"
        ),
        (F.count("*") - distinct_pairs).alias("unique_combination_facility_measure"),
    )
    violations = F.col("violation_count")
    return (
        per_hospital.unpivot([], per_hospital.columns, "test_name", "violation_count")
        .unionByName(per_metric.unpivot([], per_metric.columns, "test_name", "violation_count"))
        .withColumn("status", F.when(violations == 0, "PASS").otherwise("FAIL"))
    )


def audit_missing_providers(enriched: DataFrame) -> DataFrame:
    missing = _rows_where(F.col("missing_provider_data"))
    return enriched.agg(
        F.lit("int_providers_enriched: missing provider data").alias("audit_check"),
        F.count("*").alias("total_rows"),
        missing.alias("rows_missing_provider"),
        percent(missing, F.count("*"), 1).alias("pct_missing_provider"),
    )


def audit_missing_admissions(enriched: DataFrame) -> DataFrame:
    missing = _rows_where(F.col("missing_admissions_data"))
    return enriched.agg(
        F.lit("int_providers_enriched: missing admissions data").alias("audit_check"),
        F.count("*").alias("total_rows"),
        missing.alias("rows_missing_admissions"),
        percent(missing, F.count("*"), 1).alias("pct_missing_admissions"),
    )


def audit_ccn_format(providers: DataFrame) -> DataFrame:
    ccn = F.col("provider_ccn")
    return providers.agg(
        F.lit("stg_providers: CCN format profile").alias("audit_check"),
        F.count("*").alias("total_ccns"),
        _rows_where(F.length(ccn) != 6).alias("ccns_not_6_chars"),
        _rows_where(ccn != F.trim(ccn)).alias("ccns_with_whitespace"),
        _rows_where(F.substring(ccn, 1, 1) == "0").alias("ccns_with_leading_zero"),
    )


def audit_ref_integrity(
    fact: DataFrame, conditions_dim: DataFrame, providers_dim: DataFrame
) -> DataFrame:
    """Admissions whose measure or facility is in no dimension.

    Counted per facility and measure before the joins, so neither join sees
    single admissions nor a key that holds many of them.
    """
    counted = fact.groupBy("facility_id", "measure_code").agg(F.count("*").alias("n"))
    joined = counted.join(
        conditions_dim.select(F.col("measure_code").alias("known_measure")),
        F.col("measure_code") == F.col("known_measure"),
        "left",
    ).join(
        providers_dim.select(F.col("facility_id").alias("known_facility")),
        F.col("facility_id") == F.col("known_facility"),
        "left",
    )
    no_measure = F.col("known_measure").isNull()
    no_facility = F.col("known_facility").isNull()

    def admissions(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    total = F.coalesce(F.sum("n"), F.lit(0))
    return joined.agg(
        F.lit("fct_readmissions: referential integrity").alias("audit_check"),
        total.alias("total_fct_rows"),
        admissions(no_measure).alias("orphaned_from_dim_conditions"),
        admissions(no_facility).alias("orphaned_from_dim_providers"),
        percent(admissions(no_measure | no_facility), total, 2).alias("pct_with_any_orphan"),
    )


def _lost_values(df: DataFrame, table: str, lost: Mapping[str, Column]) -> DataFrame:
    """Rows (table_name, column_name, lost_values); all columns are counted in one pass."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in lost.items()])
    return counts.unpivot([], list(lost), "column_name", "lost_values").select(
        F.lit(table).alias("table_name"), "column_name", "lost_values"
    )


def cast_losses(
    raw_metrics: DataFrame, raw_hospitals: DataFrame, raw_providers: DataFrame | None = None
) -> DataFrame:
    """Values that mean something and still become NULL in staging, per column.

    Known "no value" texts and numbers are no losses.
    """

    def texts(targets: dict) -> dict[str, Column]:
        return {
            name: raw(name).isNotNull()
            & ~raw(name).isin(*sentinels)
            & casts.sentinel_cast(raw(name), to, sentinels).isNull()
            for name, (to, sentinels) in targets.items()
        }

    found = _lost_values(raw_metrics, "raw_hospital_readmissions", texts(METRIC_CASTS)).unionByName(
        _lost_values(raw_hospitals, "raw_admissions", texts(HOSPITAL_CASTS))
    )
    if raw_providers is None:
        return found
    days = {
        name: raw(name).isNotNull()
        & ~raw(name).isin(*(casts.OPEN_ENDED_DATES if name == "terminationDate" else ()))
        & casts.yyyymmdd_to_date(raw(name)).isNull()
        for name in PROVIDER_DATES
    }
    return found.unionByName(_lost_values(raw_providers, "raw_providers", days))


def conform_losses(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Values that cannot be brought to a contract's type and are NULL after ``conform``.

    Only columns that arrive with another type can lose any; a table without such
    columns has no rows here.
    """
    names = [f.name for f in schema.fields if f.dataType != df.schema[f.name].dataType]
    if not names:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, lost_values long")
    conformed = {f.name: text for f, text in zip(schema.fields, conform_sql(df.schema, schema))}
    lost = {name: raw(name).isNotNull() & F.expr(conformed[name].rpartition(" AS ")[0]).isNull() for name in names}
    return _lost_values(df, table, lost)


def all_audits(
    sources: Sources, table: Callable[[str, str], DataFrame]
) -> list[DataFrame]:
    """Every audit over the raw inputs and the models of the last refresh."""
    enriched = table("intermediate", "int_providers_enriched")
    return [
        audit_missing_providers(enriched),
        audit_missing_admissions(enriched),
        audit_ccn_format(table("staging", "stg_providers")),
        audit_ref_integrity(
            table("marts", "fct_readmissions"), table("marts", "dim_conditions"), table("marts", "dim_providers")
        ),
        dq_gate(table("staging", "stg_admissions"), table("staging", "stg_hrrp_metrics")),
        raw_profile(sources.hospitals),
        cast_losses(sources.metrics, sources.hospitals, sources.providers),
        *[conform_losses(df, name, schema) for name, (df, schema) in sources.uploads.items()],
    ]
