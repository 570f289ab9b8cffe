"""Data checks. Each returns rows ``(check, violations)``; 0 means it holds.

All of them count with partial aggregation before a shuffle, so a value shared
by very many rows reaches one task as one row per input task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_conditions(df: DataFrame, violated_when: Mapping[str, Column]) -> DataFrame:
    """Rows violating each condition, all conditions counted in one pass."""
    counts = df.agg(
        *[
            F.coalesce(F.sum(F.when(broken, 1).otherwise(0)), F.lit(0)).alias(name)
            for name, broken in violated_when.items()
        ]
    )
    return counts.unpivot([], list(violated_when), "check", "violations")


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, for several columns in one pass."""
    return row_conditions(
        df, {f"not_null_{model}_{name}": F.col(name).isNull() for name in columns}
    )


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    return _count(repeated, f"unique_{model}_{column}")


def unique_combination(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULL parts compare as equal."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return _count(repeated, f"unique_combination_{model}_{'_'.join(columns)}")


def accepted_values(df: DataFrame, model: str, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list; NULL passes."""
    strange = df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    return _count(strange, f"accepted_values_{model}_{column}")


def relationships(
    child: DataFrame,
    model: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    *,
    weight: str | None = None,
) -> DataFrame:
    """Child rows whose key has no parent; NULL keys pass.

    Child rows are counted per key first, so a key held by a large share of the
    rows is one row when it meets the parent table. ``weight`` names the column with
    the number of rows that a row of ``child`` stands for, where it is a summary.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(rows.alias("n"))
    )
    orphans = keys.join(
        parent.select(F.col(parent_column).alias("_parent")),
        F.col("_key") == F.col("_parent"),
        "left_anti",
    )
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(f"relationships_{model}_{column}").alias("check"), "violations"
    )


def all_of(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def _count(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )
