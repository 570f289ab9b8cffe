"""Columns that an operator only carries along."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of the struct that holds the caller's other columns inside an operator.
CARRIED = "__carried_columns"


def keeps_columns(*needed: str, new: Sequence[str], dropped: Sequence[str] = ()) -> Callable:
    """For operators that add the ``new`` columns: all others of the caller pass through as they are.

    The operator sees its ``needed`` columns and one struct with the others, so no name that it
    makes itself can clash with one of theirs. Columns of a new one's name are replaced.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **settings) -> DataFrame:
            others = [c for c in docs.columns if c not in needed and c not in new]
            packed = docs.select(*needed, *([F.struct(*map(quoted, others)).alias(CARRIED)] if others else []))
            found = operator(packed, *args, **settings)
            kept = [c for c in docs.columns if c in others or (c in needed and c not in dropped and c not in new)]
            return found.select(*[F.col(CARRIED)[c].alias(c) if c in others else quoted(c) for c in kept], *new)

        return run

    return decorate


def quoted(name: str) -> Column:
    """A column by its name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def same_columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``found`` with the columns of ``docs`` only."""
    return found.select(*map(quoted, docs.columns))
