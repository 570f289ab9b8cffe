"""Mixing sources to target weights: Efraimidis-Spirakis sampling to word budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.columns import CARRIED, quoted
from wardflow.session import materialize

# The word pattern of sizes, weights by place in the order of sources.
WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_EPOCHS = 2.0


def word_count(text: Column) -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    *,
    total_share: float = TOTAL_SHARE,
    most_epochs: float = MOST_EPOCHS,
) -> DataFrame:
    """``target`` for every row (source, source_size) of ``sizes``.

    Sources in order (NULL last) weigh ``weights``, repeated. ``total_share`` of all sizes
    is dealt by weight; a target stops at ``most_epochs`` times its source's size and the
    excess goes to the others by weight until none is above. The level at which that ends
    follows from one pass over the sources ordered by size for each unit of weight: a
    source is at its limit if sharing what earlier ones leave would give it more.
    There is one row for each source here, never one for each document.
    """
    ranked = sizes.withColumn("_place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    limits = ranked.select(
        "source",
        "source_size",
        weight.alias("_weight"),
        (F.col("source_size") * most_epochs).alias("_limit"),
        (F.sum("source_size").over(Window.partitionBy()) * total_share).alias("_budget"),
    )
    by_need = Window.orderBy((F.col("_limit") / F.col("_weight")), F.col("source").asc_nulls_last())
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))) / F.sum("_weight").over(rest)
    # From the first source that stays below its limit on, all get the same level.
    kept = F.when(F.col("_level") * F.col("_weight") < F.col("_limit"), F.col("_level"))
    return (
        limits.withColumn("_level", level)
        .withColumn("_final", F.first(kept, ignorenulls=True).over(by_need.rowsBetween(Window.unboundedPreceding, 0)))
        .select(
            "source",
            "source_size",
            F.coalesce(F.least(F.col("_final") * F.col("_weight"), "_limit"), "_limit").alias("target"),
        )
    )


def exponential_key(weight: Column, *identity: Column) -> Column:
    """Key -ln(u) / weight, u in (0, 1) set by the identity: the smaller, the earlier chosen."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in identity]))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def mix(
    docs: DataFrame,
    size: Column,
    quality: Column,
    *,
    source: str = "source",
    identity: str = "doc_id",
    weights: Sequence[float] = SOURCE_WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_epochs: float = MOST_EPOCHS,
) -> DataFrame:
    """``docs`` with size, source_size, target, epochs and taken (replacing such columns).

    A source's target is first filled with complete epochs, in which every document counts
    once; the rest is filled in order of exponential keys, ``-ln(u) / quality``, until the
    budget is spent. The document at the edge of the budget is taken if that brings the
    source nearer to its target. ``taken`` is the number of words the mix takes from a
    document, ``epochs`` how often it takes the document.

    ``size`` counts the words of a row (see ``word_count``). It and ``quality`` are computed
    more than once, so hand over columns that are cheap, or written before.

    ``u`` comes from the md5 of the id, so reruns agree, whatever the partitioning.
    ``quality`` must be positive; NULL counts as 1. NULL sources are a source of their own;
    a size of 0 or NULL takes nothing; rows with the same id, key
    and size are interchangeable; an empty table gives an empty one. Other columns stay.

    A source may hold most rows: keys are dealt to about sqrt(n) ranges of a source with
    n documents, sizes are summed up within each range, and a second window adds what
    the ranges before hold. No task sees more than about sqrt(n) rows of one source at once.
    """
    own = ["size", "source_size", "target", "epochs", "taken"]
    # The caller's columns travel as one, so none can clash with those made here.
    carried = F.struct(*[quoted(c) for c in docs.columns if c not in own])
    key = exponential_key(F.col("_weight"), F.col("_id"))
    sized = docs.select(
        carried.alias(CARRIED),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.coalesce(quality.cast("double"), F.lit(1.0)).alias("_weight"),
        F.col(source).alias("_from"),
        F.col(identity).alias("_id"),
    )
    totals = sized.groupBy(F.col("_from").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    totals = materialize(totals, "source_sizes")
    targets = materialize(
        source_targets(totals.select("source", "source_size"), weights, total_share=total_share, most_epochs=most_epochs)
        .join(totals.select(F.col("source").alias("_source"), "_rows"), F.col("source").eqNullSafe(F.col("_source")))
        .select(F.col("source").alias("_source"), "source_size", "target", "_rows"),
        "source_targets",
    )
    # The written targets have a known size, so Spark decides on a broadcast; where sources
    # are too many, it is a join that splits skewed sources.
    ranges = F.ceil(F.sqrt("_rows"))
    spread = 1 - F.exp(-F.col("_key"))  # grows with the key, within 0 and 1
    placed = (
        sized.withColumn("_key", key)
        .join(targets, F.col("_from").eqNullSafe(F.col("_source")))
        .withColumn("_range", F.floor(spread * ranges))
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size"))
    )
    in_range = Window.partitionBy("_source", "_range").orderBy("_key", "_id", "size")
    before = F.coalesce(F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = placed.groupBy("_source", "_range").agg(F.sum("size").alias("_range_size"))
    by_range = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = sums.select(
        F.col("_source").alias("_of"),
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_range_size").over(by_range), F.lit(0)).alias("_ranges_before"),
    )
    placed = placed.withColumn("_before", before).join(
        ranges_before, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    )
    start = F.col("_before") + F.col("_ranges_before")
    chosen = (start + F.col("size") / 2) <= F.col("_budget")
    once_more = F.when((F.col("_budget") > 0) & chosen, 1).otherwise(0)
    epochs = F.when(F.col("size") > 0, F.col("_whole") + once_more).otherwise(0).cast("int")
    return placed.withColumn("epochs", epochs).select(
        f"{CARRIED}.*", "size", "source_size", "target", "epochs", (F.col("size") * F.col("epochs")).alias("taken")
    )
