"""Rows of a group in their order, also where one group is enormous."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import materialize

ROWS_PER_SLICE = 250_000
#: Largest number of long groups that is broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def split_long_groups(
    df: DataFrame, group: str, rows_per_slice: int = ROWS_PER_SLICE
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups that fit a task, and those of the others (None if there are none).

    Rows are counted per group first, on the group column alone and before the
    shuffle. Of ``n`` rows at most ``n / rows_per_slice`` groups are long.
    """
    # A struct is never NULL and equal to one with the same content, so rows
    # without a group match by plain equality.
    member = F.struct(F.col(group).alias("v"))
    sizes = df.groupBy(member.alias("_long")).agg(F.count("*").alias("_n"))
    long = materialize(sizes.where(F.col("_n") > rows_per_slice).select("_long"), "long_groups")
    count = long.count()
    if not count:
        return df, None
    long = F.broadcast(long) if count <= BROADCAST_GROUPS else long
    return (
        df.join(long, member == F.col("_long"), "left_anti"),
        df.join(long, member == F.col("_long"), "left_semi"),
    )


def in_slices(
    df: DataFrame, group: str, order: Sequence[Column], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``_place``, growing with (group, order), and ``_slice``, runs of places.

    Rows are dealt out by ranges of (group, order), sorted, and cut into runs of at
    most ``rows_per_slice``, so a long group lies in many tasks and slices. Both columns are fixed
    by where rows lie: use a result once, or write it before using it twice.
    """
    keys = [F.col(group), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The id is the number of the partition, then that of the row in it.
    return dealt.withColumn("_place", F.monotonically_increasing_id()).withColumn(
        "_slice", F.expr(f"_place div {int(rows_per_slice)}L")
    )


def with_previous(
    df: DataFrame,
    group: str,
    order: Sequence[Column | str],
    carried: Sequence[str],
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add struct ``previous``: ``carried`` of the preceding row, NULL at the start.

    Equal to ``lag`` over ``group`` ordered by ``order`` (then by what is carried),
    but a window keeps a whole group in one task. Groups of more than
    ``rows_per_slice`` rows therefore go another way:

    * they are sorted over all tasks and cut into consecutive slices, and each
      slice is a window partition of its own;
    * the first row of a slice takes what it needs from the last row of the
      slice before: first and last rows form a second window, which holds two
      rows per slice, while the others stay spread by their slices.

    A job counts the rows per group before. Where no group is long, which is the
    common case, the result is the plain window and ``df`` is shuffled once.
    Rows that agree in all keys and carried columns are interchangeable.
    """
    names = [part for part in order if isinstance(part, str)]
    ties = [F.col(name) for name in carried if name not in names]
    sort_key = [F.col(part) if isinstance(part, str) else part for part in order] + ties
    short, long = split_long_groups(df, group, rows_per_slice)

    inner, lagged = _lag(carried, Window.partitionBy(group).orderBy(*sort_key))
    result = short.select(*df.columns, F.when(inner, lagged).alias("previous"))
    if long is None:
        return result

    in_slice = Window.partitionBy(group, "_slice").orderBy("_place")
    inner, lagged = _lag(carried, in_slice)
    cut = in_slices(long, group, sort_key, rows_per_slice).select(
        *df.columns,
        "_place",
        "_slice",
        inner.alias("_inner"),
        lagged.alias("_lagged"),
        F.lead(F.lit(True)).over(in_slice).isNull().alias("_last"),
    )
    at_edge = F.col("_inner").isNull() | F.col("_last")
    edges = Window.partitionBy(group, F.when(~at_edge, F.col("_slice"))).orderBy("_place")
    has_edge, handed = _lag(carried, edges)
    return result.unionByName(
        cut.select(
            *df.columns,
            F.when(F.col("_inner"), F.col("_lagged")).when(has_edge, handed).alias("previous"),
        )
    )


def _lag(carried: Sequence[str], window) -> tuple[Column, Column]:
    """TRUE where a row precedes (else NULL), and what is carried over from it."""
    values = F.struct(*[F.lag(name).over(window).alias(name) for name in carried])
    return F.lag(F.lit(True)).over(window), values
