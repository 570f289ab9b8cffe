"""The prefix trie against brute force, split in every way."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardflow.llm import conversation_trie as trie
from wardflow.llm import queries as registered

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_force(rows):
    """Rows of the result, by walking every prefix of every rebuilt conversation."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    ordered = {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - int(math.fmod(c, 20))  # Spark's remainder takes the sign of the id
        rebuilt[c] = ordered.get(giver, [])[:h] + own[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for path, convs_here in members.items():
        under = [p for p in members if p[: len(path)] == path]
        parents = {p[:-1] for p in members if p}
        saved = sum((len(members[p]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) for p in under if p)
        ends = ",".join(map(str, sorted(c for c in convs_here if len(rebuilt[c]) == len(path))))
        out[min(convs_here), len(path)] = (
            min(members[path[:-1]]) if path else None,
            len(convs_here),
            sum(len(p) == len(path) + 1 and p[:-1] == path for p in members),
            sum(p not in parents for p in under),
            saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def conversations(n, seed, turns=6):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.randrange(1, turns)):
            common = pick.random() < 0.7
            rows.append((c, t, "user" if t % 2 else "bot", "the same words" if common else f"turn {pick.randrange(4)} of {t}"))
    rows += [
        (20, None, None, None), (21, None, "user", ""), (21, None, "user", ""), (22, 3, None, "late"), (22, 3, "user", "late"),
        (None, 1, "user", "no conversation"), (405, 0, "user", "its giver does not exist"),
        (-41, 0, "user", "negative"), (-40, 0, "a", "b"), (-40, 1, "ab", ""), (-39, 0, "", "ab"), (-39, 1, "ab", ""),
        (200, 0, "user", "x" * 100_000), (200, 1, "user", "word " * 20_000),
    ]
    rows += [(500 + i, 0, "user", "alone") for i in range(8)]  # some lose their only turn
    rows += [(700, t, "user", f"step {t % 7}") for t in range(150)] + [(701, t, "user", f"step {t % 7}") for t in range(149)]
    return rows


def result(frame):
    return {(r.conv_id, r.depth): tuple(r[2:]) for r in frame.collect()}


def run(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("place", F.lit(-1))
    slices = {"rows_per_slice": sizes["rows_per_slice"]} if "rows_per_slice" in sizes else {}
    ordered = trie.ordered_turns(frame, **slices)
    convs, turns = trie.with_shared_heads(
        ordered, F.col("conv_id") - F.col("conv_id") % 20, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4, 3
    )
    return trie.prefix_trie(convs, turns, **sizes)


@pytest.mark.parametrize("sizes", [{}, {"part": 40, "rows_per_slice": 50}, {"part": 1, "rows_per_slice": 7}])
def test_trie_equals_brute_force_however_split(spark, sizes):
    rows = conversations(120, 5)
    if sizes.get("part") == 1:  # a round of jobs for every halving: keep it small
        rows = [r for r in rows if r[0] in range(12) or r[0] in (405, None)] + [(701, t, "user", str(t)) for t in range(20)]
    assert result(run(spark, rows, **sizes)) == brute_force(rows)


def test_no_conversations_no_rows(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(None, 1, "user", "a")]).collect() == []


def test_registered_query_on_a_small_table(spark, tmp_path):
    rows = [(c, t, "user", f"t{t % 2}") for c in range(45) for t in range(c % 5 + 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(registered.QUERIES["op12_conversation_trie"](spark, str(tmp_path))) == brute_force(rows)


def test_ids_of_a_large_node_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_CHUNK", 100)
    ids = list(range(-500, 4000, 3))
    rows = spark.createDataFrame([((1, 1 if i % 50 else 2), i) for i in ids], f"node struct<k1:long,k2:long>, conv_id long")
    got = {r.node.k2: r.ends_sha256 for r in trie.ends_digest(rows.repartition(7)).collect()}
    for k2 in (1, 2):
        text = ",".join(str(i) for i in ids if (1 if i % 50 else 2) == k2)
        assert got[k2] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_centroid_totals(shape):
    rng = np.random.default_rng(3)
    n = 700
    up = {
        "chain": np.arange(n) - 1,
        "star": np.where(np.arange(n) > 0, 0, -1),
        "random": np.array([-1] + [rng.integers(0, i) for i in range(1, n)]),
        "forest": np.array([-1 if rng.random() < 0.2 else max(-1, i - rng.integers(1, 5)) for i in range(n)]),
    }[shape]
    weights = rng.integers(0, 9, (n, 2))
    want = weights.copy()
    for i in range(n - 1, -1, -1):
        if up[i] >= 0:
            want[up[i]] += want[i]
    assert (trie.centroid_totals(up, weights) == want).all()
