"""Every operator on empty tables, NULLs, repeated rows, long texts and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from wardflow.llm import queries as registered

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
#: Columns that a table may have and that operators make themselves.
CLASHING = ("row_key", "n_words", "text_key", "key", "fp", "size", "target", "score", "n_lines", "_row", "component", "path")
#: Queries with a row for every document or vector; the others have tests of their own.
NAMES = [n for n in registered.QUERIES if not n.startswith(("op11", "op12"))]
LINE = "one two three four five six seven eight nine ten"
EN = "The cat and the dog sat by the old house while it was raining."
FR = "Le chat et le chien sont dans la vieille maison avec des amis."
BENCH = " ".join(f"b{i}" for i in range(40))


def documents():
    rows = [(i, (EN if i % 2 else FR) + f" n{i}", "en" if i % 2 else "fr", f"s{i % 3}", 10) for i in range(30)]
    rows += [
        (30, None, None, None, None),
        (31, "", "en", None, 0),
        (32, " \n\t ", None, "s1", 3),
        (None, None, None, None, None),
        (None, EN, "en", "s0", 5),
        (None, EN, "en", "s0", 5),
        (33, LINE + "\n" + LINE.replace("five", "5"), "en", "s2", 9),
        (33, LINE + "\n" + LINE.replace("five", "5"), "en", "s2", 9),
        (34, LINE + " eleven\nshort\nshort\n" + LINE, "en", "s2", 9),
        (35, "word " * 60_000, "en", "s1", 9),
        (36, "x" * 200_000, "fr", "s1", 9),
        (37, BENCH + " and more", "en", "s0", 9),
        (38, "Été \U0001f600 b0 b1 b2", "fr", "s0", 9),
        (39, "!!! 123", "fr", "s0", 9),
    ]
    return rows


def write(spark, folder, docs, bench, labels, vectors, clash=False):
    frame = spark.createDataFrame(docs, DOCS)
    if clash:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"'x' AS {name}")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality double").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def vectors():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in base[i % 12] + (0.05 * rng.normal(size=8) if i >= 12 else 0)], i % 2) for i in range(40)]
    return rows + [(40, None, 1), (41, [0.0] * 8, None), (42, [math.nan] + [1.0] * 7, 1), (43, [None] + [1.0] * 7, 1), (44, rows[0][1], 0)]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    bench = [("i1", BENCH), ("i2", None), ("i3", ""), (None, "short one"), ("i4", "b0 b1 b2"), ("i4", "b0 b1 b2")]
    labels = [(i, i % 2, 0.1 * (i % 10)) for i in range(40)] + [(None, 1, None), (3, None, None), (4, 1, 0.5)]
    make = tmp_path_factory.mktemp
    return {
        "edge": write(spark, make("edge"), documents(), bench, labels, vectors(), clash=False),
        "clash": write(spark, make("clash"), documents(), bench, labels, vectors(), clash=True),
        "empty": write(spark, make("empty"), [], [], [], []),
    }


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def found(spark, folders):
    """Rows by query on the edge table."""
    return {n: registered.QUERIES[n](spark, folders["edge"]).collect() for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_input_row(found, name):
    want = 45 if name.startswith("op7") else len(documents())
    assert len(found[name]) == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, folders, name):
    assert registered.QUERIES[name](spark, folders["empty"]).collect() == []


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("op7")])
def test_clashing_columns_change_nothing(spark, folders, found, name):
    def plain(rows):
        return sorted((repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows))

    assert plain(registered.QUERIES[name](spark, folders["clash"]).collect()) == plain(found[name])


def test_pipeline_on_edges_and_nothing(spark, folders):
    ids = [r.doc_id for r in corpus_pipeline.run(spark, folders["edge"]).collect()]
    assert not {30, 31, 32, 37, 39} & set(ids)  # no letters, or a benchmark passage
    assert corpus_pipeline.run(spark, folders["empty"]).collect() == []


def close(a, b):
    """Within one word of each other, by trying all edits."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_line_dedup_by_brute_force(found):
    texts = {r[0]: r[1] for r in documents() if r[0] is not None and r[0] != 36}
    seen = [EN.split()]  # the texts without an id come first
    got = {r.doc_id: r.removed_lines for r in found["op4_line_dedup"] if r.doc_id is not None}
    for i in sorted(texts):
        gone = []
        for k, line in enumerate((texts[i] or "").split("\n")):
            w = re.findall("[^\x20\x09-\x0d]+", line)
            if len(w) < 2:
                continue
            if any(w == s or (min(len(w), len(s)) >= 8 and close(w, s)) for s in seen):
                gone.append(str(k))
            seen.append(w)
        assert got[i] == ",".join(gone), i


def test_embedding_links_by_brute_force(found):
    ok = {i: np.array(v, float) for i, v, _ in vectors() if v and None not in v and np.isfinite(v).all() and any(v)}
    ok = {i: np.float32(v).astype(float) for i, v in ok.items()}
    links = [
        (a, b) for a, b in combinations(sorted(ok), 2)
        if ok[a] @ ok[b] / math.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= 0.95
    ]
    least = {i: i for i, _, _ in vectors()}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    n = Counter(x for link in links for x in link)
    assert links
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found["op7_embedding_dedup"]} == {
        i: (n[i], c, i == c) for i, c in least.items()
    }


def test_contamination_by_brute_force(found):
    def split(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    items = {"i1": [split(BENCH)[k : k + 13] for k in range(28)], "i4": [["b0", "b1", "b2"]]}
    got = {r.doc_id: r for r in found["op6_decontaminate"]}
    for i in (33, 37, 38, 30):
        w = split(next(r[1] for r in documents() if r[0] == i))
        hit, ids = set(), set()
        for item, windows in items.items():
            for window in windows:
                for k in range(len(w) - len(window) + 1):
                    if w[k : k + len(window)] == window:
                        hit |= set(range(k, k + len(window)))
                        ids.add(item)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        row = got[i]
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (len(w), len(hit), len(ids), digest)
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_base_scores_by_brute_force(found):
    def tokens(text):
        return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1

    counts = Counter(t for i, text, *_ in documents() if not held(i) for t in tokens(text))
    below = counts.total() + 0.5 * (len(counts) + 1)
    want = Counter()
    for i, text, *_ in documents():
        t = tokens(text)
        base = sum(math.log10((counts[x] + 0.5) / below) for x in t)
        want[i, held(i), len(t), sum(counts[x] > 0 for x in t), counts.total(), round(base, 4)] += 1
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found["op8_suffix_tree_score"])
    assert got == want
    assert all(r.score < 0 for r in found["op8_suffix_tree_score"])
