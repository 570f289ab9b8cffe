"""Hard negatives against brute force, in blocks of every size."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardflow.llm import hard_negatives as hard
from wardflow.llm import queries as registered

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, is_anchor, n_positives=5, n_negatives=3):
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, label, [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in v]))

    def score(a, b):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False))))

    out = []
    for i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-score(v, w), j, other) for j, other, w in kept if j != i)
        for minus, j, other in [s for s in scored if s[2] == label][:n_positives]:
            window = [(s, k) for s, k, o in scored if o != label and 50 * -minus <= 100 * -s <= 95 * -minus]
            out += [(i, j, rank + 1, k, -minus, -s) for rank, (s, k) in enumerate(window[:n_negatives])]
    return sorted(out)


def vectors(n, seed, width=12):
    rng = np.random.default_rng(seed)
    pick = random.Random(seed)
    centers = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        near = centers[i % 6] + rng.normal(size=width) * pick.choice([0.02, 0.3, 1.0])
        rows.append((i, [float(x) for x in near], pick.randrange(4)))
    rows += [(n + i, rows[0][1], rows[0][2] if i % 2 else 9) for i in range(8)]  # ties
    rows += [(n + 20, rows[1][1], 1), (n + 20, rows[1][1], 1), (n + 20, rows[2][1], 2)]  # an id three times
    rows += [(None, rows[0][1], 1), (n + 30, None, 1), (n + 31, [], 1), (n + 32, [1.0, 2.0], 1), (n + 33, [math.nan] * width, 1)]
    rows += [(n + 34, [None] + [0.1] * (width - 1), 1), (n + 35, [math.inf] * width, 2), (n + 36, rows[3][1], None), (n + 37, [0.0] * width, 2)]
    return rows


def run(spark, rows, is_anchor, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("anchor", F.lit("x")).withColumn("score", F.lit(0))
    return sorted(map(tuple, hard.hard_negatives(hard.quantised(frame), is_anchor, **sizes).collect()))


@pytest.mark.parametrize("block_rows", [2_048, 7, 1])
def test_equals_brute_force(spark, block_rows, monkeypatch):
    monkeypatch.setattr(hard, "RUN_ROWS", 37)
    rows = vectors(250, 11)
    step = 5 if block_rows > 1 else 50  # a pass for each block
    want = brute_force(rows, lambda i: i % step == 0)
    assert len(want) > 50 or step > 5
    assert run(spark, rows, F.col("id") % step == 0, block_rows=block_rows) == want


def test_other_numbers_of_rows(spark):
    rows = vectors(60, 3)
    want = brute_force(rows, lambda i: i % 4 == 0, 2, 7)
    assert run(spark, rows, F.col("id") % 4 == 0, n_positives=2, n_negatives=7) == want


def test_components_beyond_exact_doubles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * 10.0 ** (i % 9)], i % 3) for i in range(60)]
    rows += [(60 + i, [1e300 * (-1) ** i, 1.0], i % 2) for i in range(4)]
    assert run(spark, rows, F.col("id") % 2 == 0) == brute_force(rows, lambda i: i % 2 == 0)


def test_nothing_in_nothing_out(spark):
    assert run(spark, [], F.col("id") % 2 == 0) == []
    assert run(spark, [(1, [1.0], 1)], F.col("id") % 2 == 0) == []
    assert run(spark, [(2, [1.0], 1)], F.col("id") % 2 == 0) == []


def test_bounds_spare_most_scores_where_anchors_are_close():
    rng = np.random.default_rng(5)
    center = rng.integers(-200, 200, 32)
    block = hard.Rows(np.arange(40), np.zeros(40), center + rng.integers(-2, 3, (40, 32)))
    rows = hard.Rows(np.arange(3000), np.ones(3000), rng.integers(-200, 200, (3000, 32)))
    least = float(np.sort(rows.values @ block.values[0])[-5])
    asked = sum(len(p) for _, p, _ in hard.descend(block, hard.spanning_tree(block.values), rows, lambda a: (least, np.inf)))
    assert asked < 40 * 60
    for a, places, scores in hard.descend(block, hard.spanning_tree(block.values), rows, lambda a: (least, np.inf)):
        exact = rows.values @ block.values[a]
        assert set(places) == set(np.flatnonzero(exact >= least)) and (exact[places] == scores).all()


def test_registered_query_moves_labels(spark, tmp_path):
    rows = [r for r in vectors(150, 8) if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, label if label is None or i % 7 else (label + 1) % 10) for i, v, label in rows]
    got = registered.QUERIES["op11_hard_negatives"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == brute_force(moved, lambda i: i % 50 == 0)
