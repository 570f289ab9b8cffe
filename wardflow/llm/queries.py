"""Registered queries of the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    conversation_trie,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    mixing,
    substring_dedup,
    suffix_dedup,
    suffix_tree,
    toxicity,
)
from wardflow.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; an id that is NULL counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    net = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.identify(docs, net).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score")
    )


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").where(fold("doc_id", 5) != 0)
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return toxicity.score_toxicity(docs, labels).select(
        "doc_id",
        "held_out",
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the quality weight of the mix: 3 and 1 where labelled, else 2."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_rated")).agg(
        (1.0 + 2.0 * F.coalesce(F.avg("quality"), F.lit(0.5))).alias("_quality")
    )
    return docs.join(known, docs["doc_id"] == F.col("_rated"), "left").drop("_rated")


@query
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    docs = materialize(rated(docs, table(spark, folder, "labels")), "rated_sizes")
    mixed = mixing.mix(docs, F.col("size"), F.coalesce("_quality", F.lit(2.0)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return jaccard_join.jaccard_groups(docs).select("doc_id", "n_shingles", "component_id")


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_ids").cast("long").alias("n_near"),
    )


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.concat_ws(",", F.transform("removed_lines", lambda i: i.cast("string"))).alias("removed_lines"),
    )


@query
def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.near_duplicates(vectors).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )


@query
def op8_suffix_tree_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out"))
    scored = suffix_tree.score_texts(docs, docs.where("NOT held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files. The table has no paths: a document lies in source/id div 100/id div 10,
    and ids divisible by 10 (by 100, by all of them for the source) stand for license files."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    number = F.col("doc_id")
    parts = [F.coalesce("source", F.lit("none")), (F.floor(number / 100)).cast("string"), (F.floor(number / 10)).cast("string")]
    name = F.concat(F.when(number % 10 == 0, F.lit("LICENSE-")).otherwise(F.lit("file-")), number.cast("string"))
    depth = F.when(number % 100 == 0, F.concat_ws("/", parts[0], name)).when(
        number % 10 == 0, F.concat_ws("/", parts[0], parts[1], name)
    ).otherwise(F.concat_ws("/", *parts, name))
    found = licenses.scan_licenses(docs, F.when(number.isNotNull(), depth), number % 10 == 0)
    return found.select("doc_id", "path", "own_license", F.round("own_score", 4).alias("own_score"), "license", "inherited_from")


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations rebuilt on the first turns of the one whose id is the next lower multiple of 20."""
    conv_id = F.col("conv_id")
    heads = F.crc32(conv_id.cast("string").cast("binary")) % 4
    ordered = materialize(conversation_trie.ordered_turns(table(spark, folder, "conversations")), "ordered_turns")
    convs, turns = conversation_trie.with_shared_heads(ordered, conv_id - conv_id % 20, heads, 3)
    return conversation_trie.prefix_trie(convs, turns)


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the vectors whose id is divisible by 50; ids divisible by 7 get another label."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        hard_negatives.quantised(vectors.withColumn("label", moved)), F.col("id") % 50 == 0
    )


@query
def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_earlier_strings(docs)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
