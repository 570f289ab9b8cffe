"""Facts that hold for any input, seen on the sample tables."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from registered_queries import Frames


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, SMALL)


def test_flagging_neither_drops_nor_adds_admissions(frames):
    row = frames.flagged.agg(
        F.count("*").alias("rows"),
        F.countDistinct("admission_id").alias("ids"),
        F.count_if("is_readmission").alias("flagged"),
        F.count_if(F.col("is_readmission").isNull()).alias("unknown"),
        F.count_if(F.col("prior_admission_id").isNull()).alias("first"),
        F.count_if(F.col("days_since_prior_discharge") < 0).alias("overlapping"),
    ).first()
    assert tuple(row) == (1500, 1500, 157, 0, 150, 25)
    assert frames.raw.events.count() == 1500


def test_no_flag_breaks_the_rule(frames):
    flagged = frames.flagged.where("is_readmission")
    assert flagged.where("days_since_prior_discharge NOT BETWEEN 0 AND 30").count() == 0
    assert (
        flagged.where(
            "admission_type = 'Planned' AND diagnosis_category IN "
            "('Cancer Treatment', 'Rehabilitation', 'Transplant')"
        ).count()
        == 0
    )


def test_one_latest_record_per_provider(frames):
    providers = frames.providers
    row = providers.agg(F.count("*"), F.countDistinct("provider_ccn")).first()
    eligible = frames.raw.providers.where(
        "providerType = '00' AND fiscalYearBeginDate BETWEEN 20200101 AND 20251231"
    )
    newest = eligible.groupBy("providerCcn").agg(F.max("fiscalYearBeginDate").alias("newest"))
    assert row[0] == row[1] == newest.count()
    behind = providers.join(newest, F.col("provider_ccn") == F.col("providerCcn")).where(
        F.date_format("fiscal_year_begin_date", "yyyyMMdd").cast("bigint") != F.col("newest")
    )
    assert behind.count() == 0


def test_every_facility_with_outcomes_is_kept(frames):
    assert (
        frames.enriched.count()
        == frames.metrics.select("facility_id").distinct().count()
        == frames.enriched.select("facility_id").distinct().count()
    )
