"""Casts that turn the publisher's "no value" texts into NULL.

Malformed texts that are no known sentinel also become NULL instead of failing
the job; ``wardflow.plans.audits.cast_losses`` counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" in the published files.
COUNT_SENTINELS = ("Not Available", "Not Applicable", "Too Few to Report", "N/A", "")
DATE_SENTINELS = ("Not Available", "Not Applicable", "N/A", "")
METRIC_SENTINELS = ("Not Available", "Too Few to Report", "N/A", "")
PERIOD_SENTINELS = ("Not Available", "N/A", "")
RATING_SENTINELS = ("Not Available", "Not Applicable", "")

# yyyyMMdd numbers that mean "not terminated" and "unknown".
OPEN_ENDED_DATES = (20610701, 19000101)


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def date_of(column: Column | str) -> Column:
    """DATE from text in ISO form or, failing that, MM/dd/yyyy."""
    text = _column(column)
    return F.coalesce(text.try_cast("date"), F.try_to_date(text, "MM/dd/yyyy"))


def sentinel_cast(
    column: Column | str, to: str, sentinels: Sequence[str] = COUNT_SENTINELS
) -> Column:
    """NULL for a sentinel or an unreadable text, else the value as ``to``."""
    text = _column(column)
    value = date_of(text) if to == "date" else text.try_cast(to)
    return F.when(~text.isin(*sentinels), value) if sentinels else value


def safe_cast_int(column: Column | str) -> Column:
    return sentinel_cast(column, "int")


def safe_cast_double(column: Column | str) -> Column:
    return sentinel_cast(column, "double")


def safe_cast_date(column: Column | str) -> Column:
    return sentinel_cast(column, "date", DATE_SENTINELS)


def yyyymmdd_to_date(column: Column | str, null_values: Sequence[int] = ()) -> Column:
    """DATE from a yyyyMMdd number; ``null_values`` and invalid days are NULL."""
    number = _column(column)
    day = F.try_to_date(number.cast("string"), "yyyyMMdd")
    return F.when(~number.isin(*null_values), day) if null_values else day


def yes_no(column: Column | str) -> Column:
    """BOOLEAN from exactly 'Yes' or 'No'; anything else is NULL."""
    text = _column(column)
    return F.when(text == "Yes", True).when(text == "No", False)


# ---- the same as SQL text, for views that the catalog keeps ----


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_value(value: str | int | bool) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).upper() if isinstance(value, bool) else str(value)


def sql_values(values: Sequence[str | int]) -> str:
    return ", ".join(sql_value(value) for value in values)


def date_of_sql(text: str) -> str:
    return f"coalesce(TRY_CAST({text} AS DATE), try_to_date({text}, 'MM/dd/yyyy'))"


def sentinel_cast_sql(text: str, to: str, sentinels: Sequence[str] = COUNT_SENTINELS) -> str:
    value = date_of_sql(text) if to == "date" else f"TRY_CAST({text} AS {to})"
    return f"CASE WHEN {text} NOT IN ({sql_values(sentinels)}) THEN {value} END" if sentinels else value


def yyyymmdd_sql(number: str, null_values: Sequence[int] = ()) -> str:
    day = f"try_to_date(CAST({number} AS STRING), 'yyyyMMdd')"
    return f"CASE WHEN {number} NOT IN ({sql_values(null_values)}) THEN {day} END" if null_values else day


def yes_no_sql(text: str) -> str:
    return f"CASE {text} WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END"
