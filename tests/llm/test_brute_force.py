"""Pair and window operators against brute force on a small hand-made table."""

import hashlib
import itertools
import random
import re

import pytest
from wardflow.llm import jaccard_join
from wardflow.llm import queries as registered

WORD = re.compile("[^\x20\x09-\x0d]+")
BASE = [f"w{i}" for i in range(60)]
ROWS = [
    (1, " ".join(BASE)),
    (2, " ".join(BASE)),
    (3, " ".join([*BASE[:30], "other", *BASE[30:]])),
    (4, " ".join(BASE[:25] + ["x"] * 30)),
    (5, None),
    (6, ""),
    (7, "   \n "),
    (8, "only three words"),
    (9, "ONLY three words"),
    (10, "loop " * 50),
    (11, " ".join(f"v{i}" for i in range(3000)) + " " + " ".join(BASE[10:40])),
    (12, "a fresh text\n" + " ".join(BASE[5:35]) + "\nthat ends here"),
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("llm")
    rows = [(i, text, "en", f"s{i % 3}") for i, text in ROWS]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def result(spark, sf_dir, prefix):
    name = next(n for n in registered.QUERIES if n.startswith(prefix))
    return {r.doc_id: r for r in registered.QUERIES[name](spark, sf_dir).collect()}


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_components(spark, sf_dir):
    sets = {i: shingles(text) for i, text in ROWS}
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                least[a] = least[b] = min(least[a], least[b])
    got = result(spark, sf_dir, "op5_")
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), least[i]) for i in sets}


def test_repeated_windows_are_cut(spark, sf_dir):
    seen, want = set(), {}
    for i, text in sorted(ROWS):
        w = WORD.findall(text or "")
        gone = set()
        for at in range(len(w) - 19):
            window = tuple(w[at : at + 20])
            if window in seen:
                gone.update(range(at, at + 20))
            seen.add(window)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = result(spark, sf_dir, "op10_")
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == want


def families(seed):
    """Edited copies of some texts, in chains and of copies, that all quote one passage."""
    pick = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]

    def edited(w, most):
        w = list(w)
        for _ in range(pick.randrange(most)):
            at = pick.randrange(len(w))
            w[at : at + pick.randrange(2)] = [f"e{pick.randrange(10_000)}"]
        return w

    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(150)]
        known = [base]
        for _ in range(45):
            known.append(edited(pick.choice([base, base, *known]), 9))
        rows += [w + passage for w in known]
    rows += [[f"d{i}x{k}" for k in range(pick.randrange(2, 50))] + passage for i in range(40)]
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("bucket", [48, 3, 0])
def test_large_buckets_lose_no_link(spark, monkeypatch, bucket):
    for bound in ("BUCKET", "OUTSIDE", "CROWD"):
        monkeypatch.setattr(jaccard_join, bound, min(bucket, getattr(jaccard_join, bound)))
    rows = families(4)
    sets = {i: shingles(text) for i, text in rows}
    least = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(20):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert 20 < len(set(least.values())) < len(rows) - 60
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(frame).collect()}
    assert got == least


def test_centers_are_found_without_a_join_of_sets(spark):
    """The set in most buckets is a bucket's centre, the larger fingerprint among equals."""
    rows = [("k1", 1), ("k1", 2), ("k2", 2), ("k2", 3), ("k3", 3), ("k3", 2), ("k4", 4), ("k4", 5)]
    buckets = spark.createDataFrame(rows, "key string, fp long")
    found = jaccard_join.with_centers(buckets)
    center = {"k1": 2, "k2": 2, "k3": 2, "k4": 5}
    assert sorted(map(tuple, found.collect())) == sorted((k, fp, center[k]) for k, fp in rows)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_buckets_of_the_same_sets_get_one_center(spark):
    """A centre's sets move to the centre that at least half of them have as their widest, within one parent."""
    sets = {1: range(1, 11), 2: [2, 3, 4, 11], 20: range(20, 26), 5: [5, 30, 31], 11: [2, 11, 12, 13, 14]}
    rows = [(f"k{c}", fp, c, old) for old in (7, 8) for c, fps in sets.items() if old == 7 or c != 1 for fp in fps]
    buckets = spark.createDataFrame(rows, "key string, fp long, center long, old long")
    found = jaccard_join.with_fewer_centers(buckets, "old")
    # Among the sets of 8 there is no bucket of 1: those of 2 are divided between it and 11.
    moved = {(2, 7): 1, (2, 8): 11}
    widest = {(c, old): moved.get((c, old), c) for _, _, c, old in rows}
    assert sorted(map(tuple, found.collect())) == sorted((key, fp, widest[c, old]) for key, fp, c, old in rows)


def test_next_center_differs_least_from_the_old_one(spark):
    rows = [("k1", 1, 30, 9), ("k1", 2, 12, 9), ("k1", 3, 12, 9), ("k2", 1, 30, 9), ("k2", 4, 31, 9)]
    found = jaccard_join.with_nearest_centers(spark.createDataFrame(rows, "key string, fp long, n_grams int, old long"))
    center = {"k1": 2, "k2": 1}
    assert sorted(map(tuple, found.collect())) == sorted((key, fp, center[key], 9) for key, fp, _, _ in rows)


def test_a_set_goes_to_few_centers(spark, monkeypatch):
    """Differences are made once or so for each set of a large group of near copies, not for each bucket's centre."""
    for bound in ("BUCKET", "OUTSIDE", "CROWD"):
        monkeypatch.setattr(jaccard_join, bound, 3)
    made, make = [], jaccard_join.rare_differences

    def counted(members, sets):
        made.append((members.count(), members.select("fp").distinct().count()))
        return make(members, sets)

    monkeypatch.setattr(jaccard_join, "rare_differences", counted)
    jaccard_join.jaccard_groups(spark.createDataFrame(families(4), "doc_id long, text string")).count()
    rows, sets = made[0]
    assert sets > 50 and rows < 1.5 * sets
