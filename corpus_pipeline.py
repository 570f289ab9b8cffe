"""From raw documents to a training mix, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes each result as Parquet to the shared folder and reads it
again as the next stage's input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from wardflow.llm.columns import same_columns
from wardflow.llm.queries import rated, table
from wardflow.session import materialize

#: Documents whose best language has less than this probability are rejected, like those
#: without a letter. With four languages guessing gives 0.25.
LEAST_CERTAINTY = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told, learned from the labelled documents.

    Goes: a text that is NULL, has no letter, or is likelier to be none of the languages.
    A document that stays without a ``lang`` of its own gets the predicted one.
    """
    net = language_id.fit(docs)
    found = language_id.identify(docs, net)
    if net is not None:
        found = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("lang_score") >= LEAST_CERTAINTY))
        found = found.withColumn("lang", F.coalesce("lang", "lang_pred"))
    return same_columns(found, docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line repeats within one edit.

    ``n_chars`` follows the text. A document that loses all its lines stays, empty.
    """
    found = line_dedup.dedup_lines(docs)
    changed = F.size("removed_lines") > 0
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
    return same_columns(found.withColumn("n_chars", n_chars), docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the first by id, then by a hash.

    Documents without words are in no group and stay.
    """
    grouped = jaccard_join.jaccard_groups(docs).where("n_shingles > 0")
    # Smallest row of each group; a hot group sends one row from each task.
    first = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first"))
    stays = first.select(F.col("first.row_key").alias("row_key")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), jaccard_join.row_key("doc_id", "text").alias("row_key"))
    blank = F.coalesce(F.regexp_count("doc.text", F.lit(mixing.WORD)), F.lit(0)) == 0
    # Rows equal in id and text share the key: one of them stays.
    worded = rows.where(~blank).join(stays, "row_key", "left_semi").groupBy("row_key").agg(
        F.min_by("doc", F.xxhash64("doc")).alias("doc")
    )
    return rows.where(blank).select("doc.*").unionByName(worded.select("doc.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are not a twentieth of the words or more."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return same_columns(found.where(~F.col("contaminated")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, epochs and taken.

    Documents without words, whatever stage they lost them in, take no part.
    """
    weighed = rated(docs.withColumn("_size", mixing.word_count(F.col("text"))), table(spark, sf_dir, "labels"))
    mixed = mixing.mix(weighed, F.col("_size"), F.coalesce("_quality", F.lit(2.0)))
    return mixed.where("epochs > 0").drop("_size", "_quality")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]

#: A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
