"""Staging: rename, type, and turn "no value" texts into NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import casts
from wardflow.operators.latest import latest_per_key
from wardflow.sources.schemas import HOSPITAL_NAMES, METRIC_NAMES, PROVIDER_DATES, PROVIDER_NAMES

# Hospitals run by these owners are outside the programme.
FEDERAL_OWNERS = ("Department of Defense", "Veterans Health Administration")

# Begin dates of the fiscal years taken in, both inclusive.
FIRST_FISCAL_BEGIN = 20200101
LAST_FISCAL_BEGIN = 20251231

# Raw text columns that are cast, with the target type and the texts meaning NULL.
METRIC_CASTS = {
    "Facility ID": ("bigint", ()),
    "Number of Discharges": ("int", casts.METRIC_SENTINELS),
    "Excess Readmission Ratio": ("double", casts.METRIC_SENTINELS),
    "Predicted Readmission Rate": ("double", casts.METRIC_SENTINELS),
    "Expected Readmission Rate": ("double", casts.METRIC_SENTINELS),
    "Number of Readmissions": ("int", casts.METRIC_SENTINELS),
    "Start Date": ("date", casts.PERIOD_SENTINELS),
    "End Date": ("date", ()),
}
HOSPITAL_CASTS = {
    "Facility ID": ("bigint", ()),
    "Hospital overall rating": ("int", casts.RATING_SENTINELS),
} | {
    name: ("int", casts.COUNT_SENTINELS)
    for name in HOSPITAL_NAMES
    if name.startswith("Count of ")
}
HOSPITAL_YES_NO = (
    "Emergency Services",
    "Meets criteria for birthing friendly designation",
)


# Versions of a provider record, newest first.
VERSION_COLUMNS = ("fiscalYearBeginDate", "effectiveDate", "exportDate", "lastUpdated")


def raw(name: str) -> Column:
    """Raw column by its published name, which may hold spaces and slashes."""
    return F.col(f"`{name}`")


# Each model is defined once, as SQL text: for a DataFrame, and for a view of the catalog.


def _columns(names: Mapping[str, str], typed: Mapping[str, str]) -> list[str]:
    """The contract's columns under their new names, ``typed`` where given."""
    return [f"{typed.get(old, casts.sql_name(old))} AS {new}" for old, new in names.items()]


def _typed(targets: Mapping[str, tuple[str, Sequence[str]]]) -> dict[str, str]:
    return {name: casts.sentinel_cast_sql(casts.sql_name(name), *target) for name, target in targets.items()}


def _metric_columns() -> list[str]:
    return _columns(METRIC_NAMES, _typed(METRIC_CASTS))


def _hospital_columns() -> list[str]:
    yes_no = {name: casts.yes_no_sql(casts.sql_name(name)) for name in HOSPITAL_YES_NO}
    return _columns(HOSPITAL_NAMES, _typed(HOSPITAL_CASTS) | yes_no)


def _civilian(excluded_owners: Sequence[str]) -> str:
    return f"`Hospital Ownership` NOT IN ({casts.sql_values(excluded_owners)})"


def _provider_columns() -> list[str]:
    days = {
        name: casts.yyyymmdd_sql(name, casts.OPEN_ENDED_DATES if name == "terminationDate" else ())
        for name in PROVIDER_DATES
    }
    return _columns(PROVIDER_NAMES, days)


def _in_years(first_begin: int, last_begin: int) -> str:
    return f"fiscalYearBeginDate BETWEEN {int(first_begin)} AND {int(last_begin)}"


def stg_hrrp_metrics(raw_metrics: DataFrame) -> DataFrame:
    """Typed outcome metrics, one row per facility and measure."""
    return raw_metrics.selectExpr(*_metric_columns())


def stg_admissions(
    raw_hospitals: DataFrame, excluded_owners: Sequence[str] = FEDERAL_OWNERS
) -> DataFrame:
    """Typed hospital attributes; federal and unknown owners are left out."""
    return raw_hospitals.where(_civilian(excluded_owners)).selectExpr(*_hospital_columns())


def stg_providers(
    raw_providers: DataFrame,
    provider_types: DataFrame,
    *,
    first_begin: int = FIRST_FISCAL_BEGIN,
    last_begin: int = LAST_FISCAL_BEGIN,
) -> DataFrame:
    """Latest payment record of each eligible provider.

    Records of the same begin date are versions; the newest effective, exported
    and updated one wins, so that a rerun picks the same row.
    """
    eligible = provider_types.where("is_hrrp_eligible").select(
        F.col("provider_type_code").alias("providerType")
    )
    in_scope = raw_providers.where(_in_years(first_begin, last_begin)).join(
        eligible, "providerType", "left_semi"
    )
    newest_first = [F.col(name).desc_nulls_last() for name in VERSION_COLUMNS]
    return latest_per_key(in_scope, "providerCcn", newest_first).selectExpr(*_provider_columns())


def staging_views(
    texts: Mapping[str, str],
    *,
    excluded_owners: Sequence[str] = FEDERAL_OWNERS,
    first_begin: int = FIRST_FISCAL_BEGIN,
    last_begin: int = LAST_FISCAL_BEGIN,
) -> dict[str, str]:
    """The three models as queries over inputs given as SQL subqueries."""
    versions = ", ".join(f"{name} DESC NULLS LAST" for name in VERSION_COLUMNS)
    ranked = (
        f"SELECT p.*, row_number() OVER (PARTITION BY providerCcn ORDER BY {versions}) AS _rank "
        f"FROM {texts['providers']} p LEFT SEMI JOIN {texts['provider_types']} t "
        f"ON p.providerType = t.provider_type_code AND t.is_hrrp_eligible "
        f"WHERE {_in_years(first_begin, last_begin)}"
    )
    return {
        "stg_hrrp_metrics": f"SELECT {', '.join(_metric_columns())} FROM {texts['metrics']}",
        "stg_admissions": f"SELECT {', '.join(_hospital_columns())} FROM {texts['hospitals']} WHERE {_civilian(excluded_owners)}",
        "stg_providers": f"SELECT {', '.join(_provider_columns())} FROM ({ranked}) WHERE _rank = 1",
    }
