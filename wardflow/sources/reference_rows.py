"""Small fixed lookup tables, built from rows kept here."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardflow.functions.casts import sql_value
from wardflow.sources.schemas import PROVIDER_TYPES

# Provider type codes (text: leading zeros count).
PROVIDER_TYPE_ROWS = [
    ("00", "Short-term Acute Care Hospital", "Hospital", True),
    ("01", "Hospital", "Hospital", False),
    ("02", "Long-term Care Hospital", "Hospital", False),
    ("03", "Religious Non-medical Health Care Institution", "Hospital", False),
    ("04", "Critical Access Hospital", "Hospital", False),
    ("05", "Childrens Hospital", "Hospital", False),
    ("06", "Cancer Hospital", "Hospital", False),
    ("07", "Rehabilitation Hospital", "Hospital", False),
    ("08", "Psychiatric Hospital", "Hospital", False),
    ("14", "Indian Health Service Hospital", "Hospital", False),
    ("15", "Other Hospital", "Hospital", False),
    ("16", "Veterans Affairs Hospital", "Hospital", False),
    ("17", "Tribal Hospital", "Hospital", False),
    ("33", "Other", "Other", False),
    ("35", "Other Specialty Hospital", "Hospital", False),
    ("36", "Skilled Nursing Facility", "SNF", False),
    ("37", "Other Skilled Nursing", "SNF", False),
    ("38", "Nursing Facility", "SNF", False),
    ("49", "Home Health Agency", "HHA", False),
    ("50", "Hospice", "Hospice", False),
    ("51", "Comprehensive Outpatient Rehabilitation Facility", "CORF", False),
]

# The published measures and their display names.
CONDITION_ROWS = [
    ("READM-30-AMI-HRRP", "Heart Attack (AMI)", "Cardiac", 1),
    ("READM-30-HF-HRRP", "Heart Failure", "Cardiac", 2),
    ("READM-30-PN-HRRP", "Pneumonia", "Respiratory", 3),
    ("READM-30-COPD-HRRP", "COPD", "Respiratory", 4),
    ("READM-30-HIP-KNEE-HRRP", "Hip/Knee Replacement", "Surgical", 5),
    ("READM-30-CABG-HRRP", "Coronary Artery Bypass (CABG)", "Surgical", 6),
]

MEASURE_CODES = [row[0] for row in CONDITION_ROWS]


CONDITIONS = T.StructType(
    [
        T.StructField("measure_code", T.StringType()),
        T.StructField("condition_name", T.StringType()),
        T.StructField("condition_category", T.StringType()),
        T.StructField("sort_order", T.IntegerType()),
    ]
)


def _local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a local relation, whose exact size the optimizer can see."""
    columns = [list(values) for values in zip(*rows)]
    table = pa.table(columns, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def provider_type_codes(spark: SparkSession) -> DataFrame:
    return _local_table(spark, PROVIDER_TYPE_ROWS, PROVIDER_TYPES)


def provider_type_values() -> str:
    """The same as a SQL subquery."""
    rows = ", ".join(f"({', '.join(map(sql_value, row))})" for row in PROVIDER_TYPE_ROWS)
    return f"(SELECT * FROM VALUES {rows} AS t({', '.join(PROVIDER_TYPES.names)}))"


def condition_rows(spark: SparkSession) -> DataFrame:
    return _local_table(spark, CONDITION_ROWS, CONDITIONS)
