"""Scores of the suffix tree against a tree made in Python that holds every kept context."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from wardflow.llm import suffix_tree
from wardflow.llm.suffix_tree import DEPTH, GAIN, LEAST_COUNT


def corpus():
    pick = random.Random(5)
    names = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(3_500)]
    told = names * 60
    pick.shuffle(told)
    texts = [" ".join(told[i : i + 300]) for i in range(0, len(told), 300)]
    return texts, [*texts[:3], "a text that was NOT learned from", "", None, " \n"]


def steps(text):
    """(context, symbol) for every symbol of a text; NUL stands for what is before and after it."""
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    stream = "\0" * DEPTH + "".join(w + " " for w in words) + "\0"
    return [(stream[i - DEPTH : i], stream[i]) for i in range(DEPTH, len(stream))]


@pytest.fixture(scope="module")
def expected():
    training, texts = corpus()
    grams = Counter(x for text in training for x in steps(text))
    counts = defaultdict(Counter)
    for (context, symbol), n in grams.items():
        for d in range(DEPTH + 1):
            counts[context[DEPTH - d :]][symbol] += n
    total = {c: sum(n.values()) for c, n in counts.items()}
    kept = [
        c for c, seen in counts.items()
        if c and total[c] >= LEAST_COUNT
        and sum(n * math.log(n / total[c] / (counts[c[1:]][s] / total[c[1:]])) for s, n in seen.items()) > GAIN * len(seen)
    ]
    states = {""} | {c[a:b] for c in kept for a in range(len(c)) for b in range(a + 1, len(c) + 1)}

    def probability(context, symbol):
        p = 1 / 256
        for d in range(DEPTH + 1):
            c = context[DEPTH - d :]
            if c in states:
                weight = len(counts[c]) if d else 128
                p = (counts[c][symbol] + weight * p) / (total[c] + weight)
        return p

    scores = {i: sum(math.log10(probability(*x)) for x in steps(text)) for i, text in enumerate(texts)}
    return training, texts, len(kept), scores


@pytest.mark.parametrize("bound", [1 << 20, 4_000, 0])
def test_all_kept_contexts_are_used(spark, monkeypatch, expected, bound):
    """More contexts than any task gets: what the table of common states leaves out is joined."""
    monkeypatch.setattr(suffix_tree, "COMMON_SYMBOLS", bound, raising=False)
    training, texts, n_kept, scores = expected
    assert n_kept > 6_000
    learned = spark.createDataFrame([(t,) for t in training], "text string")
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    found = suffix_tree.score_texts(docs, learned).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        assert r.score == pytest.approx(scores[r.doc_id], abs=1e-6)
