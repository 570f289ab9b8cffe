"""Benchmark decontamination with a positional inverted index over the documents.

The index holds postings (document, position) of the rarest words of the benchmark's
windows. A posting of the word at place k of an item, shifted by k, is where the item
would begin; lists that meet at the same beginning are candidates, and all words of the
item are then compared along it. Built on DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.columns import keeps_columns, quoted
from wardflow.session import materialize

WINDOW = 13
#: Words an item's three rarest words may lie apart in a proximity match.
NEAR = 26
RAREST = 3

# What separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text as an array; none for NULL."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def item_words(items: DataFrame) -> DataFrame:
    """Rows (item_key, item_id, words) for the items that have words."""
    return (
        items.select("item_id", words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0).distinct()
        .withColumn("item_key", F.xxhash64("item_id", "words"))
    )


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows (word, n): how often words of the vocabulary occur in all documents."""
    return (
        docs.select(F.explode("words").alias("word")).join(vocabulary, "word")
        .groupBy("word").agg(F.count("*").alias("n"))
    )


def index_terms(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """Rows (word, item_key, place, rare): which words of an item the index looks up.

    For each window of an item the two rarest places; windows with a word that no document
    has cannot occur. ``rare`` marks the item's rarest words, for proximity matches.
    """
    placed = items.select("item_key", F.posexplode("words").alias("place", "word"))
    rated = (
        placed.join(counts, "word", "left")
        .groupBy("item_key")
        .agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("_all"))
    )
    width = F.least(F.size("_all"), F.lit(window))

    def rarest_two(start: Column) -> Column:
        part = F.slice(F.col("_all"), start, width)
        by_count = F.array_sort(F.transform(part, lambda x: F.struct(x["n"].alias("n"), x["place"].alias("place"), x["word"].alias("word"))))
        return F.when(F.get(by_count, F.lit(0))["n"] > 0, F.slice(by_count, 1, 2)).otherwise(F.slice(by_count, 1, 0))

    starts = F.sequence(F.lit(1), F.size("_all") - width + 1)
    present = F.filter("_all", lambda x: x["n"] > 0)
    distinct_words = F.array_distinct(
        F.transform(
            F.array_sort(F.transform(present, lambda x: F.struct(x["n"].alias("n"), x["word"].alias("word")))),
            lambda x: x["word"],
        )
    )
    anchors = rated.select("item_key", F.explode(F.array_distinct(F.flatten(F.transform(starts, rarest_two)))).alias("_x"))
    anchors = anchors.select(F.col("_x.word").alias("word"), "item_key", F.col("_x.place").alias("place"), F.lit(False).alias("rare"))
    rare = rated.select("item_key", F.explode(F.slice(distinct_words, 1, RAREST)).alias("word"))
    return anchors.union(rare.select("word", "item_key", F.lit(-1).alias("place"), F.lit(True).alias("rare")))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (row_key, at, word, item_key, place, rare): where documents have the terms."""
    return (
        docs.select("row_key", F.posexplode("words").alias("at", "word"))
        .join(terms, "word")
    )


def aligned(index: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (row_key, item_key, begin): where two looked-up words of an item agree on its
    beginning (one, for an item of a single word)."""
    lengths = items.select("item_key", F.size("words").alias("_n"))
    return (
        index.where("NOT rare")
        .groupBy("row_key", "item_key", (F.col("at") - F.col("place")).alias("begin"))
        .agg(F.count("*").alias("_found"))
        .join(lengths, "item_key").where("_found >= least(2, _n)")
        .select("row_key", "item_key", "begin")
    )


def near_matches(index: DataFrame, terms: DataFrame, near: int) -> DataFrame:
    """Rows (row_key, item_key): documents that hold all rarest words of an item within
    ``near`` words (only items with at least two such words)."""
    wanted = terms.where("rare").groupBy("item_key").agg(F.count("*").alias("_wanted")).where("_wanted > 1")
    hit = F.expr(
        "size(collect_set(word) OVER (PARTITION BY row_key, item_key ORDER BY at "
        f"RANGE BETWEEN CURRENT ROW AND {near - 1} FOLLOWING))"
    )
    return (
        index.where("rare").withColumn("_hit", hit).join(wanted, "item_key")
        .where("_hit = _wanted").select("row_key", "item_key").distinct()
    )


@keeps_columns("doc_id", "text", new=("n_words", "n_hit", "item_ids", "spans", "near_ids", "contaminated"))
def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, near: int = NEAR, share: int = 20
) -> DataFrame:
    """``docs`` (doc_id, text, others) with n_words, n_hit, item_ids, spans, near_ids, contaminated.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. A word
    of a document is hit if it lies inside an occurrence of a window; ``contaminated`` where
    n_hit > 0 and share * n_hit >= n_words. ``item_ids`` are the items with occurring windows
    as sorted text, ``spans`` their occurrences (item_id, begin, end in words, end excluded),
    ``near_ids`` the items whose three rarest words lie within ``near`` words of each other.

    NULL and empty texts have no words and are clean; items without words match nothing;
    an item without id hits words but is not listed. Repeated documents each get the same
    answer, repeated items count once, an empty table of either side gives clean documents.
    Columns of the result's names are replaced, others stay.
    """
    id_type = dict(items.dtypes)["item_id"]
    row_key = F.xxhash64("doc_id", "text").alias("row_key")
    worded = docs.select(row_key, words_of(F.col("text")).alias("words"))
    items = materialize(item_words(items), "benchmark_items")
    # Written tables have a known size: Spark broadcasts them if they are small, and
    # otherwise shuffles the words of the documents to them, which is the index at large.
    vocabulary = materialize(items.select(F.explode("words").alias("word")).distinct(), "benchmark_words")
    counts = materialize(word_counts(worded, vocabulary), "word_counts")
    terms = materialize(index_terms(items, counts, window), "index_terms")
    index = materialize(postings(worded, terms), "postings")
    begins = aligned(index, items).join(items, "item_key").groupBy("row_key").agg(
        F.collect_list(F.struct("item_id", "begin", "words")).alias("begins")
    )
    hits = materialize(verified_hits(docs.select(row_key, "text"), begins, window, id_type), "hits")
    close = (
        near_matches(index, terms, near).join(items.select("item_key", "item_id"), "item_key")
        .groupBy("row_key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("near_ids"))
    )
    # What a filter on the result reads are columns of the small tables, never the words of a text.
    found = docs.select("*", row_key).join(hits, "row_key", "left").join(close, "row_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = {"item_ids": "array<string>", "spans": span_type(id_type), "near_ids": "array<string>"}
    lists = {name: F.coalesce(name, F.array().cast(kind)).alias(name) for name, kind in none.items()}
    return found.select(
        *map(quoted, docs.columns),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        *lists.values(),
        ((n_hit > 0) & (n_hit * share >= F.col("n_all"))).alias("contaminated"),
    ).withColumn("contaminated", F.coalesce("contaminated", F.lit(False)))


def span_type(id_type: str) -> str:
    return f"array<struct<item_id:{id_type},begin:int,end:int>>"


def verified_hits(texts: DataFrame, begins: DataFrame, window: int, id_type: str) -> DataFrame:
    """Rows (row_key, n_all, n_hit, spans, item_ids) for documents in which windows occur.

    ``begins`` lists where items may begin; their words are compared with the document's.
    """

    def occurrences(x: Column) -> Column:
        """Windows of an item that stand in the document."""
        n = F.size(x["words"])
        width = F.least(n, F.lit(window))
        same = F.transform(
            x["words"], lambda w, k: F.coalesce(F.get(F.col("words"), x["begin"] + k) == w, F.lit(False))
        )
        starts = F.filter(
            F.sequence(F.lit(0), n - width), lambda s: ~F.array_contains(F.slice(same, s + 1, width), False)
        )
        return F.transform(
            starts,
            lambda s: F.struct(
                x["item_id"].alias("item_id"), (x["begin"] + s).alias("begin"), (x["begin"] + s + width).alias("end")
            ),
        )

    # Texts are shuffled, not their words; only those with a candidate are split then.
    spans = texts.join(begins, "row_key").withColumn("words", words_of(F.col("text"))).select(
        "row_key", F.size("words").alias("n_all"), F.flatten(F.transform("begins", occurrences)).alias("spans")
    )
    spans = materialize(spans.dropDuplicates(["row_key"]), "occurrences").where(F.size("spans") > 0)
    hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["end"] - 1)))))
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("spans", lambda s: s["item_id"].cast("string")), lambda i: i.isNotNull())))
    return spans.select("row_key", "n_all", hit.alias("n_hit"), "spans", ids.alias("item_ids"))
