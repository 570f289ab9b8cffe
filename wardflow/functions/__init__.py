"""Reusable column expressions. All of them are built-in Spark functions."""

from wardflow.functions.casts import (  # noqa: F401
    date_of,
    safe_cast_date,
    safe_cast_double,
    safe_cast_int,
    sentinel_cast,
    yes_no,
    yyyymmdd_to_date,
)
from wardflow.functions.rules import (  # noqa: F401
    is_readmission,
    measure_code_of,
    penalty_band,
    percent,
    settled_avg,
)
