"""Line dedup within an edit bound of one word, by a deletion-neighbourhood join.

Lines are compared as sequences of words. Two lines within one edit (a word replaced,
inserted or left out) have a common member in their deletion neighbourhoods: the line
itself and the line without one of its words. Every member becomes a hashed key; lines
that share a key are candidates and are verified by their words. A line that has an
earlier line within the bound is removed. Built on DataFrame functions only.

Most lines have no such partner, so a first join finds the lines that share their first or
last half with another line: one edit leaves one of the halves alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.columns import keeps_columns
from wardflow.session import materialize

#: Words a line needs to be compared at all, and to be compared with one edit.
LEAST_WORDS = 2
LEAST_WORDS_EDIT = 8

# White space between words.
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(line: Column) -> Column:
    """Words of a line. Most lines have plain spaces only, which are quicker to split at."""
    odd = line.rlike(r"[\x09-\x0D]")
    return F.array_remove(F.when(odd, F.split(line, BLANKS)).otherwise(F.split(line, " ")), "")


def lines_of(docs: DataFrame) -> DataFrame:
    """Rows (place, row_key, line_no, line, words, n, h1, h2) of the lines that are compared.

    ``place`` orders lines: by doc_id (NULL first), a hash of the text, and line number.
    """
    return (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            F.xxhash64("doc_id", "text").alias("row_key"),
            F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
        )
        .withColumn("words", words_of(F.col("line")))
        .withColumn("n", F.size("words"))
        .where(F.col("n") >= LEAST_WORDS)
        .select(
            F.struct("doc_id", "text_key", "line_no").alias("place"),
            "row_key",
            "line_no",
            "line",
            "words",
            "n",
            F.xxhash64("words").alias("h1"),
            F.xxhash64(F.lit(1), "words").alias("h2"),
        )
    )


def half_keys(words: Column, n: Column) -> Column:
    """Hashes of the first and last half, as halves are for this length and one less."""

    def halves(p: Column) -> Column:
        return F.array(
            F.xxhash64(F.lit("first"), p, F.slice(words, F.lit(1), p)),
            F.xxhash64(F.lit("last"), p, F.slice(words, n - p + 1, p)),
        )

    longer, shorter = F.floor((n - 1) / 2).cast("int"), F.floor((n - 2) / 2).cast("int")
    return F.array_distinct(F.concat(halves(longer), halves(shorter)))


def neighbourhood(lines: DataFrame) -> DataFrame:
    """Rows (variant, without, h1) of distinct lines: a key for the line (without = 0) and
    one for the line without its word at place ``without``.

    The hash of a sequence is the sum of hashes of its words with their places, so all
    variants of a line follow from sums over the words before and after the gap.
    """
    by_line = Window.partitionBy("h1").orderBy("at")
    worded = lines.select("h1", "n", F.posexplode("words").alias("at", "word"))

    def placed(shift: int) -> Column:
        return F.shiftright(F.xxhash64("word", F.col("at") - shift), 24)

    before = F.coalesce(F.sum(placed(0)).over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.coalesce(F.sum(placed(1)).over(by_line.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    whole = F.when(F.col("at") == F.col("n") - 1, F.col("_before") + placed(0))
    summed = worded.select("h1", "n", "at", "word", before.alias("_before"), after.alias("_after"))
    both = F.array(
        F.struct(F.xxhash64(F.col("_before") + F.col("_after"), F.col("n") - 1).alias("variant"), (F.col("at") + 1).alias("without")),
        F.struct(F.xxhash64(whole, F.col("n")).alias("variant"), F.when(whole.isNotNull(), 0).alias("without")),
    )
    return summed.select("h1", F.explode(both).alias("_x")).where("_x.without IS NOT NULL").select("_x.variant", "_x.without", "h1")


def one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are within one edit of each other."""
    n, m = F.size(a), F.size(b)
    different = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    shorter, longer = F.when(n < m, a).otherwise(b), F.when(n < m, b).otherwise(a)
    ahead = F.array_position(F.zip_with(longer, shorter, lambda x, y: ~x.eqNullSafe(y)), True)
    # Up to the first difference they agree; without that word the rest must agree too.
    rest = F.slice(longer, ahead.cast("int") + 1, F.size(longer)) == F.slice(shorter, ahead.cast("int"), F.size(longer))
    return F.when(n == m, different <= 1).when(F.abs(n - m) == 1, rest).otherwise(False)


def near_repeats(hashed: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows (h1, h2) of the distinct lines that have an earlier line within one edit.

    ``hashed`` (h1, halves) are the lines as keys, ``lines`` the lines themselves.
    """
    keyed = hashed.select("h1", F.explode("halves").alias("key"))
    lowest, highest = F.expr("min(h1) OVER (PARTITION BY key)"), F.expr("max(h1) OVER (PARTITION BY key)")
    suspects = keyed.withColumn("_a", lowest).withColumn("_b", highest).where("_a <> _b").select("h1").distinct()
    suspects = materialize(suspects, "suspect_lines")
    # One row for each distinct suspect line: its earliest place and its words. Suspects grow
    # with the lines; a merge join is planned for them at every size.
    distinct = (
        lines.where(F.col("n") >= LEAST_WORDS_EDIT).select("h1", "h2", "n", "line", "place")
        .join(suspects.hint("merge"), "h1", "left_semi")
        .groupBy("h1").agg(
            F.min("place").alias("place"), F.first("h2").alias("h2"), F.first("n").alias("n"), F.first("line").alias("line")
        )
        .select("h1", "place", "h2", "n", words_of(F.col("line")).alias("words"))
    )
    distinct = materialize(distinct, "distinct_lines")
    lowest, highest = F.expr("min(h1) OVER (PARTITION BY variant)"), F.expr("max(h1) OVER (PARTITION BY variant)")
    shared = (
        neighbourhood(distinct).withColumn("_a", lowest).withColumn("_b", highest)
        .where("_a <> _b").select("variant", "without", "h1")
    )
    placed = shared.join(distinct.select("h1", "place"), "h1")
    placed = materialize(placed.withColumn("_me", F.struct("place", "h1")), "shared_variants")
    # Lines that lack the same place differ in that word alone; a whole line and one that
    # lacks a word differ by it. So the earliest of either kind is what matters.
    replaced = placed.where("without > 0").groupBy("variant", "without").agg(F.min("_me").alias("_first"))
    whole = placed.where("without = 0").groupBy("variant").agg(F.min("_me").alias("_first"))
    longer = placed.where("without > 0").groupBy("variant").agg(F.min("_me").alias("_first"))
    pairs = (
        placed.where("without > 0").join(replaced, ["variant", "without"]).select("_me", "_first")
        .union(placed.where("without > 0").join(whole, "variant").select("_me", "_first"))
        .union(placed.where("without = 0").join(longer, "variant").select("_me", "_first"))
        .where("_first.place < _me.place")
        .select(F.col("_me.h1").alias("h1"), F.col("_first.h1").alias("g1")).distinct()
    )
    other = distinct.select(F.col("h1").alias("g1"), F.col("words").alias("_words"))
    return (
        pairs.join(distinct.select("h1", "h2", "words"), "h1").join(other, "g1")
        .where(one_edit(F.col("words"), F.col("_words"))).select("h1", "h2").distinct()
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Rows (row_key, removed): numbers of the lines of a document that go, in order."""
    lines = lines_of(docs)
    halves = F.when(F.col("n") >= LEAST_WORDS_EDIT, half_keys(F.col("words"), F.col("n")))
    hashed = materialize(
        lines.select("h1", "h2", "place", "row_key", "line_no", halves.alias("halves")), "hashed_lines"
    )
    near = materialize(near_repeats(hashed, lines).withColumn("_near", F.lit(True)), "near_lines")
    places = hashed.drop("halves")
    first = places.groupBy("h1", "h2").agg(F.min("place").alias("_first"))
    return (
        places.join(first, ["h1", "h2"]).join(near, ["h1", "h2"], "left")
        .where("_near OR place <> _first")
        .groupBy("row_key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    )


@keeps_columns("doc_id", "text", new=("n_lines", "removed_lines"))
def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, others) with n_lines, removed_lines, and text without those lines.

    A line of at least two words goes if the same words stand in an earlier line, of the
    same document or another; one of at least eight words also if an earlier line of at
    least eight words is within one edit. Earlier means a smaller doc_id (NULL first, then
    by a hash of the text) or the same document and a smaller number; also a line that is
    removed itself counts. White space within a line does not matter. Shorter lines and
    blank ones stay.

    A NULL text stays NULL and has no lines; an empty one has a blank line. Rows equal in id
    and text are one document: their lines are kept or removed alike. No rows give no rows.
    Columns of the result's names are replaced, others stay.
    """
    own = ("n_lines", "removed_lines")
    keep = [c for c in docs.columns if c not in own]
    removed = repeated_lines(docs.select("doc_id", "text"))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("removed_lines"), i))
    return (
        docs.select(*keep, F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.xxhash64("doc_id", "text").alias("row_key"))
        .join(removed, "row_key", "left")
        .withColumn("removed_lines", F.coalesce("removed", F.array().cast("array<int>")))
        .withColumn("text", F.when(F.size("removed_lines") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")))
        .select(*keep, *own)
    )
