"""Business rules as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The readmission rule.
READMISSION_WINDOW_DAYS = 30
PLANNED_TYPE = "Planned"
PLANNED_EXCLUSIONS = ("Cancer Treatment", "Rehabilitation", "Transplant")

# Diagnosis category -> published measure.
MEASURE_BY_DIAGNOSIS = {
    "Heart Failure": "READM-30-HF-HRRP",
    "AMI": "READM-30-AMI-HRRP",
    "Pneumonia": "READM-30-PN-HRRP",
    "COPD": "READM-30-COPD-HRRP",
    "Hip Replacement": "READM-30-HIP-KNEE-HRRP",
    "CABG": "READM-30-CABG-HRRP",
}

# Labels of the payment adjustment bands (two start with "4.").
NO_FACTOR_BAND = "4. No financial data"
PENALTY_BANDS = (
    (1.0, "1. No penalty (factor >= 1.0)"),
    (0.99, "2. Light penalty (0.99-1.0)"),
    (0.97, "3. Moderate penalty (0.97-0.99)"),
)
HEAVY_BAND = "4. Heavy penalty (<0.97)"


def is_readmission(
    prior_discharge: Column,
    admission: Column,
    admission_type: Column,
    diagnosis: Column,
    *,
    window_days: int = READMISSION_WINDOW_DAYS,
    exclusions: Sequence[str] = PLANNED_EXCLUSIONS,
) -> Column:
    """TRUE when a stay follows an earlier discharge within the window.

    The window is inclusive at both ends, planned stays for an excluded
    diagnosis never count, and a first stay is FALSE. An unknown type or
    diagnosis leaves the answer NULL where it would decide it.
    """
    in_window = F.datediff(admission, prior_discharge).between(0, window_days)
    planned = (admission_type == PLANNED_TYPE) & diagnosis.isin(*exclusions)
    return prior_discharge.isNotNull() & in_window & ~planned


def measure_code_of(
    diagnosis: Column, mapping: Mapping[str, str] = MEASURE_BY_DIAGNOSIS
) -> Column:
    """Published measure of a diagnosis category, NULL when there is none."""
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), diagnosis)


def penalty_band(factor: Column) -> Column:
    band = F.when(factor.isNull(), NO_FACTOR_BAND)
    for lower, label in PENALTY_BANDS:
        band = band.when(factor >= lower, label)
    return band.otherwise(HEAVY_BAND)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as rounded percent of ``whole``; NULL when there is no whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def settled_avg(column: Column, digits: int) -> Column:
    """Rounded average over decimals.

    A sum of doubles depends on the order in which tasks deliver their parts,
    which can flip a rounded last digit between two runs; decimals cannot.
    """
    return F.round(F.avg(column.cast("decimal(18,8)")), digits).cast("double")


def exact_avg(column: Column) -> Column:
    """Average that is the same in whatever order values are added; NULL without values.

    Values are added as fixed-point numbers of 12 digits after the point, which keeps what
    published ratios and rates hold. Values of 1e14 or more, and NaN, are left out.
    """
    fixed = column.try_cast("decimal(26,12)")
    return F.try_divide(F.sum(fixed).cast("double"), F.count(fixed).cast("double"))
