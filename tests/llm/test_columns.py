"""Operators leave the caller's columns as they are, whatever their names."""

import pytest
from pyspark.sql import functions as F
from wardflow.llm import (
    decontaminate,
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    substring_dedup,
    suffix_dedup,
    suffix_tree,
    toxicity,
)

import corpus_pipeline

#: Names that operators use inside, and some with odd characters.
INNER = (
    "row_key key fp n words h1 h2 place at label id version own text_key removed starts order_key size _words _found _near _seen _cut "
    "_row _common _rare _sum _group _links _source _from _id _rows _key _weight _range _whole _budget _before _predicted _n _toxic _text "
    "component center spans begin end n_all occurrences votes terms doc first `dotted.name` with space"
).split()
INNER = [n for n in INNER if "`" not in n] + ["dotted.name", "with space", "back`tick"]
TEXTS = [
    "The cat and the dog sat by the old house while it was raining on the roof of it.",
    "Le chat et le chien sont dans la vieille maison avec des amis et il pleut sur le toit.",
    "one two three four five six seven eight nine ten",
    None,
    "",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, TEXTS[i % 5], "en" if i % 5 == 0 else "fr", f"s{i % 3}", 10) for i in range(40)] + [(None, TEXTS[0], None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")


def extended(frame):
    for k, name in enumerate(n for n in INNER if n not in frame.columns):
        frame = frame.withColumn(name, F.lit(k))
    return frame


def vectors(spark):
    rows = [(i, [float(i % 4), 1.0, float(i % 3)]) for i in range(20)] + [(20, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def benchmark(spark):
    return spark.createDataFrame([("i1", TEXTS[2]), ("i2", None)], "item_id string, text string")


def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")


CASES = {
    "identify": lambda s, d: language_id.identify(d, language_id.fit(d.select("text", "lang"))),
    "score_toxicity": lambda s, d: toxicity.score_toxicity(d, labels(s)),
    "dedup_lines": lambda s, d: line_dedup.dedup_lines(d),
    "contamination": lambda s, d: decontaminate.contamination(d, benchmark(s)),
    "remove_repeats": lambda s, d: substring_dedup.remove_repeats(d),
    "remove_earlier_strings": lambda s, d: suffix_dedup.remove_earlier_strings(d),
    "score_texts": lambda s, d: suffix_tree.score_texts(d, d),
    "mix": lambda s, d: mixing.mix(d, mixing.word_count(F.col("text")), F.lit(1.0)),
    "near_duplicates": lambda s, d: embedding_dedup.near_duplicates(d),
}


def rounded(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", CASES)
def test_other_columns_pass_through(spark, docs, name):
    plain = vectors(spark) if name == "near_duplicates" else docs
    wide = extended(plain)
    want, got = CASES[name](spark, plain), CASES[name](spark, wide)
    new = [c for c in want.columns if c not in plain.columns]
    lost = [c for c in plain.columns if c not in want.columns]
    extra = [n for n in wide.columns if n not in plain.columns and n not in new]
    assert sorted(got.columns) == sorted([c for c in want.columns if c not in extra] + extra)
    assert lost in ([], ["text"])
    values = {n: k for k, n in enumerate(n for n in INNER if n not in plain.columns)}
    rows = got.collect()
    for row in rows:
        assert all(row[n] == values[n] for n in extra)
    keep = [c for c in want.columns if c not in extra]
    assert sorted((repr(rounded([r[c] for c in keep])) for r in rows)) == sorted(repr(rounded([r[c] for c in keep])) for r in want.collect())


def test_stages_keep_columns_and_blank_documents_take_no_part(spark, docs, tmp_path):
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    labels(spark).selectExpr("*", "0.5 AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    wide = extended(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, str(tmp_path))
        assert found.columns == wide.columns and found.count() > 0
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert mixed.where("text IS NULL OR text = ''").isEmpty() and not mixed.isEmpty()


def test_filter_on_contamination_splits_no_text(spark, docs):
    found = decontaminate.contamination(docs, benchmark(spark)).where(~F.col("contaminated")).select("doc_id", "text")
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "contaminated" in text or "n_hit" in text
    assert "split(" not in text
