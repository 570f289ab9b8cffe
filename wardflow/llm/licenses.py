"""License scan: sparse TF-IDF cosine of lines to templates, then directory inheritance.

Every line of every file is compared with the license templates; a file declares the license
of its best line. A directory's license is what its license file declares, and files that
declare none inherit from their nearest directory above that has one, found by joining the
paths of their directories. Built on DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import materialize

THRESHOLD = 0.6

# License names with the words of their usual notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("Proprietary", "All rights reserved"),
)
SEPARATORS = r"[^a-z0-9]+"


def terms_of(text: Column) -> Column:
    """Different terms of a line: runs of letters a-z and digits, in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), SEPARATORS)), "")


def template_terms(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    frame = spark.createDataFrame(rows, "template int, name string, text string")
    return frame.select("template", F.explode(terms_of(F.col("text"))).alias("term"))


def term_weights(files: DataFrame) -> DataFrame:
    """Rows (term, idf, w0, w1, ...): template terms with their inverse document frequency over
    all files and their weight in each template, scaled to length 1."""
    templates = template_terms(files.sparkSession)
    vocabulary = materialize(templates.select("term").distinct(), "license_terms")
    seen = files.select(F.explode(terms_of(F.col("text"))).alias("term")).join(vocabulary, "term")
    counted = seen.groupBy("term").agg(F.count("*").alias("df"))
    total = files.agg(F.count("*").alias("files"))
    idf = F.log((F.col("files") + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0
    weighed = vocabulary.join(counted, "term", "left").join(F.broadcast(total)).select("term", "files", idf.alias("idf"))
    lengths = templates.join(weighed, "term").groupBy("template").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("_length"))
    scaled = templates.join(weighed, "term").join(lengths, "template")
    columns = [
        F.coalesce(F.sum(F.when(F.col("template") == i, F.col("idf") / F.col("_length"))), F.lit(0.0)).alias(f"w{i}")
        for i in range(len(TEMPLATES))
    ]
    return materialize(scaled.groupBy("term", "idf", "files").agg(*columns), "license_weights")


def declared(files: DataFrame, threshold: float) -> DataFrame:
    """Rows (row_key, own_license, own_score): the best line of the files that declare one."""
    weights = term_weights(files)
    lines = files.select("row_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    terms = lines.withColumn("_terms", terms_of(F.col("line"))).select(
        "row_key", "line_no", F.size("_terms").alias("_n"), F.explode("_terms").alias("term")
    )
    # A term that no template has is as rare as a term can be.
    unknown = F.log(F.col("files") + 1.0) + 1.0
    dots = [F.sum(F.col("idf") * F.col(f"w{i}")).alias(f"d{i}") for i in range(len(TEMPLATES))]
    scored = (
        terms.join(weights, "term").groupBy("row_key", "line_no")
        .agg(
            F.sum(F.col("idf") * F.col("idf")).alias("_known"),
            F.first(unknown).alias("_unknown"),
            F.first("_n").alias("_n"),
            F.count("*").alias("_k"),
            *dots,
        )
        .withColumn("_norm", F.sqrt(F.col("_known") + (F.col("_n") - F.col("_k")) * F.col("_unknown") * F.col("_unknown")))
    )
    options = F.array(
        *[
            F.struct(F.round(F.col(f"d{i}") / F.col("_norm"), 6).alias("score"), (-F.col("line_no")).alias("line"), F.lit(-i).alias("template"))
            for i in range(len(TEMPLATES))
        ]
    )
    best = scored.select("row_key", F.array_max(options).alias("_best")).where(F.col("_best.score") >= threshold)
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    return best.groupBy("row_key").agg(F.max("_best").alias("_best")).select(
        "row_key",
        F.element_at(names, 1 - F.col("_best.template")).alias("own_license"),
        F.col("_best.score").alias("own_score"),
    )


def scan_licenses(files: DataFrame, path: Column, is_license_file: Column, *, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (text, others) with path, own_license, own_score, license and inherited_from.

    ``own_license`` is the template nearest to any line of the file, NULL below ``threshold``
    (ties: the earlier line, then the earlier template). A file without one gets the license
    of its nearest directory above whose license file declares one; ``inherited_from`` is that
    directory, NULL where the license is the file's own. Of several license files in a
    directory the first by path counts.

    A NULL or empty text declares nothing; a NULL path inherits nothing; rows with the same
    path and text get the same answer; no rows give no rows. Columns of the result's names
    are replaced, others stay.
    """
    own = ("path", "own_license", "own_score", "license", "inherited_from")
    keep = [c for c in files.columns if c not in own]
    located = files.select(*keep, path.alias("path"), F.coalesce(is_license_file, F.lit(False)).alias("_is"))
    located = located.withColumn("row_key", F.xxhash64("path", "text"))
    found = materialize(declared(located.select("row_key", "text"), threshold), "declared_licenses")
    narrow = located.select("row_key", "path", "_is").distinct().join(found, "row_key", "left")
    narrow = materialize(narrow, "file_licenses")
    parts = F.split("path", "/")
    parent = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
    directories = (
        narrow.where("_is AND own_license IS NOT NULL").groupBy(parent.alias("directory"))
        .agg(F.min(F.struct("path", "own_license")).alias("_file"))
        .select("directory", F.col("_file.own_license").alias("_license"))
    )
    depths = F.sequence(F.lit(1), F.size(parts) - 1)
    above = (
        narrow.where("own_license IS NULL AND size(split(path, '/')) > 1").select("row_key", parts.alias("_parts"), F.explode(depths).alias("_depth"))
        .select("row_key", "_depth", F.array_join(F.slice("_parts", F.lit(1), F.col("_depth")), "/").alias("directory"))
        .join(directories, "directory")
        .groupBy("row_key").agg(F.max(F.struct("_depth", "directory", "_license")).alias("_nearest"))
    )
    answers = narrow.join(above, "row_key", "left").select(
        "row_key",
        "own_license",
        "own_score",
        F.coalesce("own_license", F.col("_nearest._license")).alias("license"),
        F.when(F.col("own_license").isNull(), F.col("_nearest.directory")).alias("inherited_from"),
    )
    answers = answers.dropDuplicates(["row_key"])
    return located.drop("_is").join(answers, "row_key").select(*keep, *own)
