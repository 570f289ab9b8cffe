"""Readers for the raw tables: catalog tables, parquet or CSV files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardflow.functions.casts import date_of_sql, sql_name
from wardflow.sources import schemas
from wardflow.sources.reference_rows import provider_type_codes, provider_type_values


@dataclass(frozen=True)
class Sources:
    """The five inputs of the transformation."""

    metrics: DataFrame
    providers: DataFrame
    hospitals: DataFrame
    events: DataFrame
    provider_types: DataFrame
    #: The same inputs as SQL subqueries, where they are catalog tables.
    texts: Mapping[str, str] = field(default_factory=dict)
    #: Tables as they were uploaded with the contract each is brought to, by table name.
    uploads: Mapping[str, tuple[DataFrame, T.StructType]] = field(default_factory=dict)


# Table (and file) names of the inputs.
RAW_TABLES = {
    "metrics": ("raw_hospital_readmissions", schemas.RAW_METRICS),
    "providers": ("raw_providers", schemas.RAW_PROVIDERS),
    "hospitals": ("raw_admissions", schemas.RAW_HOSPITALS),
}
SEED_TABLES = {
    "events": ("raw_readmissions_events", schemas.ADMISSION_EVENTS),
    "provider_types": ("cms_provider_type_codes", schemas.PROVIDER_TYPES),
}


# Two-character codes that lose a leading zero when an upload guesses a number.
TYPE_CODE_COLUMNS = ("providerType", "provider_type_code")


def conform_sql(have: T.StructType, schema: T.StructType) -> list[str]:
    """SQL text of each column of the contract, made from the columns of a table.

    Columns that already fit are passed through untouched, so scans stay pushable.
    """
    types = {field.name: field.dataType for field in have.fields}
    columns = []
    for field in schema.fields:
        name = text = sql_name(field.name)
        if types.get(field.name) != field.dataType:
            if field.dataType == T.DateType() and types.get(field.name) == T.StringType():
                text = date_of_sql(name)
            else:
                text = f"TRY_CAST({name} AS {field.dataType.simpleString()})"
            if field.name in TYPE_CODE_COLUMNS:
                # lpad would cut a longer code to its first two characters.
                text = f"CASE WHEN length({text}) < 2 THEN lpad({text}, 2, '0') ELSE {text} END"
        columns.append(text if text == name else f"{text} AS {name}")
    return columns


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the contract's columns by name and bring them to its types.

    Uploads and CSV files arrive with guessed types and extra columns. A value that
    cannot be read becomes NULL; ``wardflow.plans.audits.conform_losses`` counts them.
    """
    return df.selectExpr(*conform_sql(df.schema, schema))


def conformed_table(spark: SparkSession, table: str, schema: T.StructType) -> str:
    """SQL subquery that brings a catalog table to a contract."""
    return f"(SELECT {', '.join(conform_sql(spark.table(table).schema, schema))} FROM {table})"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; columns are matched by name, types never guessed."""
    return conform(spark.read.option("header", True).csv(path), schema)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def sources_from_files(spark: SparkSession, folder: str, file_format: str = "parquet") -> Sources:
    """Inputs from ``<folder>/<table>.<format>`` files or folders."""
    read = {"parquet": read_parquet, "csv": read_csv}[file_format]
    return Sources(
        **{
            name: read(spark, f"{folder.rstrip('/')}/{table}.{file_format}", schema)
            for name, (table, schema) in (RAW_TABLES | SEED_TABLES).items()
        }
    )


def sources_from_catalog(
    spark: SparkSession,
    raw_schema: str = "workspace.hrrp_raw",
    seed_schema: str = "hrrp_seeds",
    *,
    bundled_provider_types: bool = False,
) -> Sources:
    """Inputs from catalog tables, three raw ones and two lookup/event tables."""
    tables = {name: (f"{raw_schema}.{table}", schema) for name, (table, schema) in RAW_TABLES.items()}
    for name, (table, schema) in SEED_TABLES.items():
        if name != "provider_types" or not bundled_provider_types:
            tables[name] = (f"{seed_schema}.{table}", schema)
    frames = {name: conform(spark.table(table), schema) for name, (table, schema) in tables.items()}
    texts = {name: conformed_table(spark, table, schema) for name, (table, schema) in tables.items()}
    if bundled_provider_types:
        frames["provider_types"] = provider_type_codes(spark)
        texts["provider_types"] = provider_type_values()
    uploads = {table: (spark.table(table), schema) for table, schema in tables.values()}
    return Sources(**frames, texts=texts, uploads=uploads)
