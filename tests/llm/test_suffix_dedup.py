"""Suffix arrays and the removal of earlier byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardflow.llm import queries as registered
from wardflow.llm import suffix_dedup as dedup
from wardflow.llm.suffix_arrays import suffix_arrays

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("symbols", [1, 2, 3, 26, 250])
def test_suffix_arrays_of_many_texts(symbols):
    pick = random.Random(symbols)
    for _ in range(60):
        texts = [[pick.randrange(symbols) for _ in range(pick.choice([0, 1, 2, 5, 30, 90]))] for _ in range(pick.randrange(1, 9))]
        bounds = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
        want = [b + i for t, b in zip(texts, bounds, strict=False) for i in sorted(range(len(t)), key=lambda i, t=t: t[i:])]
        got = suffix_arrays(np.array([s for t in texts for s in t], np.int64), bounds)
        assert got.tolist() == want


def test_suffix_arrays_of_regular_texts():
    words = [b"", b"a" * 50, b"ab" * 40, b"abcabcab", b"banana", b"mississippi"]
    a, b = b"a", b"ab"
    for _ in range(9):
        a, b = b, b + a  # Fibonacci words
    texts = [*words, b, b[::-1]]
    bounds = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    got = suffix_arrays(np.frombuffer(b"".join(texts), np.uint8).astype(np.int64), bounds)
    assert got.tolist() == [b + i for t, b in zip(texts, bounds, strict=False) for i in sorted(range(len(t)), key=lambda i, t=t: t[i:])]
    assert suffix_arrays(np.empty(0, np.int64), np.array([0])).tolist() == []


def brute_force(rows, length=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for at in range(len(data) - length + 1):
                w = data[at : at + length]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 2, bool)
        if i is not None:
            for at in range(len(data) - length + 1):
                if first[data[at : at + length]] < i:
                    gone[at + 1 : at + 1 + length] = True
        kept = bytes(c for c, g in zip(data, gone[1:], strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def documents(seed):
    pick = random.Random(seed)
    syllables = ["the", "un", "à", "ge ", "keit", " wo", "é", "ß ", "and "]

    def prose(n):
        return "".join(pick.choice(syllables) for _ in range(n))

    passages = [prose(n) for n in (15, 20, 30, 60, 200)]
    rows = []
    for i in range(60):
        parts = [prose(pick.randrange(40)) + pick.choice([*passages, "", ""]) for _ in range(pick.randrange(1, 5))]
        rows.append((pick.randrange(-20, 80), "".join(parts)))
    common = "a passage that very many of the documents here do share with each other"
    rows += [(1000 + i, f"{prose(12)}{common}{prose(12)}") for i in range(80)]
    rows += [
        (None, None), (None, rows[0][1]), (None, common), (3, None), (4, ""), (5, "x" * 49), (6, "x" * 50), (7, "x" * 5_000),
        (8, "ab" * 3_000), (9, "ba" * 100 + "x" * 60), (500, rows[0][1]), (500, rows[0][1]), (500, rows[1][1]), (501, rows[1][1] + "x"),
        (502, passages[4] * 40), (503, "😀" * 30), (504, "é" + "😀" * 13), (505, "è" + "😀" * 13),
    ]
    return rows


def run(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "version", "own", "label", "n_bytes", "spans", "_cut", "start"):
        frame = frame.withColumn(name, F.lit("x"))
    found = dedup.remove_earlier_strings(frame.repartition(3), **sizes)
    assert found.columns == [c for c in frame.columns if c != "n_bytes"] + ["n_bytes", "n_removed", "removed_spans", "kept"]
    assert found.where("id <> 'x' OR own <> 'x' OR spans <> 'x'").isEmpty()
    return found.collect()


def digest(rows):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed_spans), hashlib.sha256(r.kept).hexdigest()) for r in rows), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"label_pieces": 3}, {"label_pieces": 3, "length": 20}, {"length": 5}])
def test_equals_brute_force(spark, sizes):
    rows = documents(2)
    got = run(spark, rows, **sizes)
    want = brute_force(rows, sizes.get("length", 50))
    assert digest(got) == want
    assert sum(w[2] > 0 for w in want) > 30
    for r in got:
        data, gone = (r.text or "").encode(), [range(s.begin, s.end) for s in r.removed_spans]
        assert r.kept == bytes(c for i, c in enumerate(data) if not any(i in g for g in gone))


def test_long_texts_are_labelled_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "RUN_BYTES", 300)
    monkeypatch.setattr(dedup, "SORT_BYTES", 2_000)
    rows = documents(5)
    assert digest(run(spark, rows)) == brute_force(rows)


def test_registered_query(spark, tmp_path):
    rows = documents(9)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = registered.QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(rows)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert registered.QUERIES["op13_suffix_dedup"](spark, f"{tmp_path}/none").collect() == []
