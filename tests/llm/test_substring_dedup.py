"""Repeated windows against brute force where passages, common phrases and anchors repeat often."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardflow.llm import substring_dedup


def documents():
    pick = random.Random(3)
    phrase = [f"p{i}" for i in range(14)]
    passages = [[f"s{k}w{i}" for i in range(60)] for k in range(6)]
    rows = []
    for i in range(160):
        text = [f"d{i}x{k}" for k in range(pick.randrange(40))]
        text += phrase if pick.random() < 0.7 else []
        a = pick.randrange(40)
        text += pick.choice(passages)[a : a + pick.randrange(15, 60)] + [f"e{pick.randrange(5)}"] * pick.randrange(30)
        rows.append((i // 2 if i % 40 == 0 else i, " ".join(text)))
    return rows + [(None, rows[7][1]), (900, rows[9][1]), (900, rows[9][1]), (901, None), (902, "one two"), (903, "again " * 70)]


def removed(rows, length):
    """Places of words that go, by id and text; texts of one id in the order the operator says."""
    seen, gone = set(), defaultdict(set)
    for i, text, _ in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        w = (text or "").split()
        for at in range(len(w) - length + 1):
            window = tuple(w[at : at + length])
            if window in seen:
                gone[i, text].update(range(at, at + length))
            seen.add(window)
    return gone


@pytest.mark.parametrize(("length", "crowd"), [(20, 1_000), (20, 1), (20, 60), (7, 1_000), (2, 1), (1, 1_000)])
def test_every_repeated_window_is_cut(spark, monkeypatch, length, crowd):
    monkeypatch.setattr(substring_dedup, "CROWD", crowd, raising=False)
    docs = spark.createDataFrame(documents(), "doc_id long, text string").repartition(3)
    rows = [tuple(r) for r in docs.select("doc_id", "text", substring_dedup.order_key("text")).collect()]
    want = removed(rows, length)
    found = substring_dedup.remove_repeats(docs, length=length).collect()
    assert len(found) == len(rows)
    for r in found:
        got = {k for span in r.removed_spans for k in range(span.begin, span.end)}
        assert got == want[r.doc_id, r.text], (r.doc_id, r.text)


def test_windows_of_an_anchor_are_one_row(spark):
    """A long passage that two texts share is sent in fewer rows than it has windows."""
    passage = " ".join(f"w{i}" for i in range(2_000))
    docs = spark.createDataFrame([(1, passage), (2, passage)], "doc_id long, text string").repartition(2, "doc_id")
    docs = docs.withColumn("row_key", F.col("doc_id"))
    places = substring_dedup.repeated_places(substring_dedup.anchors(docs, 20))
    near = docs.join(places, "row_key").withColumn("order_key", substring_dedup.order_key("text"))
    sent = substring_dedup.long_windows(near.select("doc_id", "order_key", "text", "places"), 20, np.empty(0, np.int64)).collect()
    assert sum(len(r.windows) for r in sent) == 2 * 1_981
    assert len(sent) < 2 * 1_981 / 3
