"""Exact Jaccard self-join of documents as sets of word n-grams.

Sets within distance d (the size of the symmetric difference) are found by the pigeonhole
principle: all possible n-grams are dealt by hash to m segments, d differences touch at
most d segments, so at least m - d segments hold the same subset in both sets. For
similarity 0.8 two sets of sizes s and t differ by (s + t) / 9 at most.

* Levels (``LEVELS``): a pair meets at the level of its smaller set, which sets m. A set
  that is large enough for partners below its level goes to two levels.
* Cost-based allocation: m is about twice what is needed, so a set need not index every
  segment. Segments are ordered by how common their content is (empty ones last), and a set
  with at most d differences to any partner indexes the d + 1 rarest. Both sets of a pair
  share m - d equal segments and choose in the same order, so both choose a common one.
  How common an n-gram is is counted over all documents; only its order matters for speed,
  any order gives all pairs.
* At the first level, where sets differ by one n-gram at most, the whole set is one segment
  and gives its key and the keys of its one-deletion neighbourhood.

Sets that share a key meet as a star: one of them, the centre, is verified with each other.
Pairs that the stars leave in different components are taken up again:

* in a bucket of few sets, pair by pair;
* in a larger one by what sets do not share with the centre. With x and y the differences of
  two sets to the centre, similar sets differ by |x ^ y| <= d, so x and y have all but about
  d / 2 members of the smaller one in common. Of each difference the rarest members are
  indexed, d / 2 + 1 of the smaller and d + 1 of the larger one (any two orders that agree will
  do); a common one makes the pair a candidate. A member that again very many sets have is a
  bucket of its own with a centre of its own, and so on: every round takes its centres out.
  Buckets of largely the same sets share one centre, so a set's difference is made once or so
  and not for every bucket it is in.

Candidates are verified on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import words
from wardflow.llm.components import components
from wardflow.session import materialize

WORDS = 5
#: Similarity as a fraction: 80 / 100. Levels and numbers of keys follow from it (``levels_of``).
SIMILARITY = (80, 100)
#: Buckets are compared pair by pair up to this many sets, or this many outside the largest component.
BUCKET, OUTSIDE = 48, 8
#: Sets outside the largest component up to which those with a common difference are compared.
CROWD = 64
#: Smallest size of each level.
LEVELS = np.array([4, 8] + [1 << e for e in range(5, 41, 2)])
#: Bound of the table of common n-grams.
COMMON = 1 << 16


def shingle_sets(column: pa.Array, length: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its different n-grams.

    Fewer words than ``length`` are one n-gram; NULL, empty and blank texts have none.
    """
    for run in words.runs(column, lower=True):
        grams, bounds = run.grams(length)
        for i, (_, own) in enumerate(run.texts()):
            if len(own) >= length:
                yield np.unique(grams[bounds[i] : bounds[i + 1]])
            elif len(own):
                yield words.gram_hashes(own, len(own)) ^ np.uint64(len(own))
            else:
                yield own


def fingerprint(grams: np.ndarray) -> int:
    """64 bits that equal sets share."""
    a, b = words.mixed(grams), words.mixed(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    both = np.array([a.sum(dtype=np.uint64), np.bitwise_xor.reduce(b), len(grams)], np.uint64)
    return int(words.gram_hashes(both, 3).view(np.int64)[0])


def levels_of(size: int) -> list[tuple[int, int]]:
    """Levels at which a set of this size meets partners, and the most differences there."""
    own = int(np.searchsorted(LEVELS, size, side="right")) - 1
    part, whole = SIMILARITY
    below = int(np.searchsorted(LEVELS, -(-size * part // whole), side="right")) - 1
    found = [(own, size * (whole - part) // part)] if own >= 0 else []
    if 0 <= below < own:
        found.append((below, 2 * size * (whole - part) // (whole + part)))
    return found


def segment_keys(grams: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Keys under which a set is indexed (see above)."""
    keys = []
    for level, differences in levels_of(len(grams)):
        salt = np.uint64(level + 1)
        if level == 0:
            mixed = words.mixed(grams)
            total = mixed.sum(dtype=np.uint64)
            keys.append(words.mixed(np.append(total - mixed, total) + salt))
            continue
        m = np.uint64(LEVELS[level] * 2)
        segment = (grams >> np.uint64(20)) % m
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        begins = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        content = np.add.reduceat(words.mixed(grams[order]), begins)
        key = words.mixed(content + words.mixed(segment[begins] * np.uint64(64) + salt))
        chosen = differences + 1
        # Empty segments come last in the order. Only where there are too few others, they
        # are indexed too: both sets of a pair then have some in common.
        if chosen > len(key):
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), segment[begins])
            key = np.append(key, words.mixed(words.mixed(empty * np.uint64(64) + salt))[: chosen - len(key)])
        elif chosen < len(key):
            cost = np.zeros(len(grams), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, grams[order]), len(common) - 1)
                cost = np.where(common[at] == grams[order], counts[at], 0)
            key = key[np.lexsort((key, np.minimum.reduceat(cost, begins)))[:chosen]]
        keys.append(key)
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """How often a set hits each bit, modulo 2, as 64-bit words: two to four bits for an n-gram.

    Two sets that differ in d members differ in d bits at most. The table of half the size
    is the two halves of this one, added.
    """
    bits = max(64, 1 << (2 * len(grams) - 1).bit_length())
    hits = np.bincount((words.mixed(grams) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(hits.astype(np.uint8), bitorder="little").view(np.int64)


def describe(docs: DataFrame, length: int) -> DataFrame:
    """Narrow rows of two kinds, from one pass over the texts.

    kind 0: a document (row_key, set fingerprint, set size, parity bits; the latter once for
    equal sets of a batch). kind 1: an n-gram (in ``fp``)
    that several different sets of a batch have, and how many (in ``n``).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes, seen, members, parity = [], [], set(), [], []
            for grams in shingle_sets(batch.column("text"), length):
                fp = fingerprint(grams) if len(grams) else 0
                fps.append(fp)
                sizes.append(len(grams))
                parity.append(parity_bits(grams) if fp not in seen and len(grams) else None)
                if fp not in seen:
                    seen.add(fp)
                    members.append(grams)
            shared, n = np.unique(np.concatenate([np.empty(0, np.uint64), *members]), return_counts=True)
            often = n >= 3
            shared, n = shared[often].view(np.int64), n[often]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([0, 1], np.int8), [len(fps), len(n)])),
                    pa.array([*batch.column("row_key").to_pylist(), *[None] * len(n)], pa.int64()),
                    pa.array([*batch.column("doc_id").to_pylist(), *[None] * len(n)], pa.int64()),
                    pa.array(np.concatenate([np.array(fps, np.int64), shared])),
                    pa.array(np.concatenate([np.array(sizes, np.int64), n])),
                    pa.array([*parity, *[None] * len(n)], pa.list_(pa.int64())),
                ],
                names=["kind", "row_key", "doc_id", "fp", "n", "parity"],
            )

    return docs.mapInArrow(
        rows, "kind byte, row_key long, doc_id long, fp long, n long, parity array<long>"
    )


def index_keys(docs: DataFrame, length: int, common: list[tuple[int, int]]) -> DataFrame:
    """Rows (key, fp); equal sets of a batch are indexed once."""
    table = sorted(common)
    grams_table = np.array([g for g, _ in table], np.int64).view(np.uint64)
    counts_table = np.array([n for _, n in table], np.int64)
    order = np.argsort(grams_table)
    grams_table, counts_table = grams_table[order], counts_table[order]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            keys, fps, size = [], [], 0
            for grams in shingle_sets(batch.column("text"), length):
                fp = fingerprint(grams) if len(grams) else 0
                if not len(grams) or fp in seen:
                    continue
                seen.add(fp)
                own = segment_keys(grams, grams_table, counts_table)
                keys.append(own.view(np.int64))
                fps.append(np.full(len(own), fp, np.int64))
                size += len(own)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(fps))], names=["key", "fp"])
                    keys, fps, size = [], [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(fps))], names=["key", "fp"])

    return docs.mapInArrow(rows, "key long, fp long")


def sets_of(docs: DataFrame, length: int) -> DataFrame:
    """Rows (fp, grams) for the given documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sets, size = [], [], 0
            for grams in shingle_sets(batch.column("text"), length):
                if len(grams):
                    fps.append(fingerprint(grams))
                    sets.append(grams.view(np.int64))
                    size += len(grams)
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "grams"])
                    fps, sets, size = [], [], 0
            if fps:
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "grams"])

    return docs.mapInArrow(rows, "fp long, grams array<long>")


def similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    a = sets.select(F.col("fp").alias("a"), F.col("grams").alias("_a"))
    b = sets.select(F.col("fp").alias("b"), F.col("grams").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.join(a, "a").join(b, "b")
        .where(shared * SIMILARITY[1] >= (F.size("_a") + F.size("_b") - shared) * SIMILARITY[0])
        .select("a", "b")
    )


def may_be_similar(n: str, bits: str, m: str, other_bits: str) -> Column:
    """Whether sizes and parity bits of two sets (names of columns) leave the similarity possible."""

    def folded(bits: str, other: str) -> Column:
        half = (F.size(bits) / 2).cast("int")
        halves = F.zip_with(F.slice(F.col(bits), F.lit(1), half), F.slice(F.col(bits), half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > F.size(other), halves).otherwise(F.col(bits))

    differing = F.aggregate(
        F.zip_with(folded(bits, other_bits), folded(other_bits, bits), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    part, whole = SIMILARITY
    near = F.least(n, m) * whole >= F.greatest(n, m) * part
    return near & (differing * (part + whole) <= (F.col(n) + F.col(m)) * (whole - part))


def with_centers(buckets: DataFrame) -> DataFrame:
    """Rows (key, fp, center): the centre of a bucket is the set that is in most buckets.

    An original shares more with its edited copies than they do with each other.
    """
    # A set has a bounded number of keys, so it is no large group.
    degree = buckets.withColumn("_degree", F.count("*").over(Window.partitionBy("fp")))
    best = degree.groupBy("key").agg(F.max(F.struct("_degree", "fp"))["fp"].alias("center"))
    return buckets.join(best, "key").select("key", "fp", "center")


def with_nearest_centers(buckets: DataFrame) -> DataFrame:
    """Rows (key, fp, center, old): the centre is the set that differs least from the ``old`` one.

    What all sets of such a bucket have and the old centre lacks, or the other way round, the new
    centre shares with them; of what it has besides, each set's difference grows, so it is to be little.
    """
    best = buckets.groupBy("key").agg(F.min(F.struct("n_grams", "fp"))["fp"].alias("center"))
    return buckets.join(best, "key").select("key", "fp", "center", "old")


def with_fewer_centers(buckets: DataFrame, *within: str) -> DataFrame:
    """Rows (key, fp, center): buckets of largely the same sets get one centre.

    A set goes to each centre of its buckets, which costs its whole difference each time. The sets
    of a centre move on to the one that most of them have as their widest. Any set will do as a
    centre, also one from outside a bucket, as long as it is verified with each of the sets. Only
    centres that stay take others in, so they keep being one of their own sets, and only centres of
    equal ``within`` meet.
    """
    members = buckets.select(*within, "center", "fp").distinct()
    sizes = members.groupBy(*within, "center").agg(F.count("*").alias("_size"))
    # A set has a bounded number of keys, so it is no large group.
    widest = Window.partitionBy(*within, "fp").orderBy(F.col("_size").desc(), "center")
    sized = members.join(sizes, [*within, "center"]).withColumn("_widest", F.first("center").over(widest))
    votes = sized.groupBy(*within, "center", "_size", "_widest").agg(F.count("*").alias("_votes"))
    best = votes.groupBy(*within, "center", "_size").agg(F.max(F.struct("_votes", "_widest")).alias("_best"))
    moves = (F.col("_best._widest") != F.col("center")) & (F.col("_best._votes") * 2 >= F.col("_size"))
    best = materialize(best.select(*within, "center", F.when(moves, F.col("_best._widest")).alias("_to")), "centers")
    stay = best.where("_to IS NULL").select(*within, F.col("center").alias("_to"))
    moved = best.join(stay, [*within, "_to"])
    return buckets.join(moved, [*within, "center"], "left").select("key", "fp", F.coalesce("_to", "center").alias("center"))


def placed_in(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``component``; a set without links is its own."""
    of_set = labels.select(F.col("node").alias("fp"), F.col("component").alias("_own"))
    return buckets.join(of_set, "fp", "left").select(*buckets.columns, F.coalesce("_own", "fp").alias("component"))


def apart_from_center(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of sets that are not in one component with their centre."""
    if labels is None:
        return buckets.where("fp <> center")
    of_center = labels.select(F.col("node").alias("center"), F.col("component").alias("_center"))
    both = placed_in(buckets, labels).join(of_center, "center", "left")
    return both.where(F.col("component") != F.coalesce("_center", "center"))


def scattered(placed: DataFrame, *key: str) -> DataFrame:
    """Rows (key, size, outside) of buckets with sets of different components; ``outside`` the largest one."""
    parts = placed.groupBy(*key, "component").agg(F.count("*").alias("_n"))
    sums = parts.groupBy(*key).agg(F.sum("_n").alias("size"), (F.sum("_n") - F.max("_n")).alias("outside"))
    return sums.where("outside > 0")


def pairs_of_few(placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of a bucket that lie in different components."""
    a = placed.select("key", F.col("fp").alias("a"), F.col("component").alias("_p"))
    b = placed.select("key", F.col("fp").alias("b"), F.col("component").alias("_q"))
    return a.join(b, "key").where("a < b AND _p <> _q").select("a", "b")


def rare_differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (center, gram, fp, component, n_grams, indexed): the rarest members of the
    difference between a set and its centre, as many as a similar set can lack.

    Similar sets differ by (s + t) / 9 members at most, a quarter of either one's size (at 0.8).
    """
    part, whole = SIMILARITY
    most = f"_n * {whole - part} div {part}"
    own = sets.select("fp", F.col("grams").alias("_own"))
    other = sets.select(F.col("fp").alias("center"), F.col("grams").alias("_other"))
    apart = members.where("fp <> center").join(own, "fp").join(other, "center").select(
        "center", "fp", "component", F.size("_own").alias("_n"),
        F.concat(F.array_except("_own", "_other"), F.array_except("_other", "_own")).alias("_apart"),
    )
    grams = apart.select("center", "fp", "component", "_n", F.size("_apart").alias("n_grams"), F.explode("_apart").alias("gram"))
    grams = materialize(grams, "difference_grams")
    # What one set alone has comes first in the order and meets nobody: it is only counted.
    counts = grams.groupBy("center", "gram").agg(F.count("*").alias("_often")).where("_often > 1")
    of_set = Window.partitionBy("center", "fp")
    alone = F.col("n_grams") - F.count("*").over(of_set)
    ranked = grams.join(counts, ["center", "gram"]).withColumn(
        "_rank", alone + F.row_number().over(of_set.orderBy("_often", "gram"))
    )
    return ranked.where(f"_rank <= {most} + 1").select(
        "center", "gram", "fp", "component", "n_grams", (F.col("_rank") <= F.expr(f"{most} div 2 + 1")).alias("indexed")
    )


def _crowded(rare: DataFrame) -> DataFrame:
    """Rows (center, gram, many): whether more than a bucket's sets would meet many others at a gram."""
    indexed = rare.groupBy("center", "gram").agg(F.count_if("indexed").alias("_indexed"))
    apart = scattered(rare, "center", "gram")
    return apart.join(indexed, ["center", "gram"]).select(
        "center", "gram", ((F.col("outside") > CROWD) & (F.col("_indexed") > CROWD)).alias("many")
    )


def pairs_of_differences(rare: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components with a common indexed member that not very many have.

    Rows carry the parity bits of their sets, so that only pairs that may be similar come out.
    """
    some = rare.join(_crowded(rare).where("NOT many").select("center", "gram"), ["center", "gram"])
    some = some.join(sketches.select("fp", F.col("n").alias("_n"), F.col("parity").alias("_bits")), "fp")
    # Both sides of the pairs read these rows.
    some = materialize(some, "shared_differences")
    names = {"fp": "", "component": "_in", "n_grams": "_apart", "_n": "_n", "_bits": "_bits"}
    a, b = (some.select("center", "gram", "indexed", *[F.col(c).alias(f"_{side}{end}") for c, end in names.items()]) for side in "ab")
    # The set that differs less from the centre is the one that is indexed.
    apart = (F.col("_a_in") != F.col("_b_in")) & (F.col("_a_apart") <= F.col("_b_apart"))
    near = apart & may_be_similar("_a_n", "_a_bits", "_b_n", "_b_bits")
    return a.where("indexed").drop("indexed").join(b.drop("indexed"), ["center", "gram"]).where(near).select(
        F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")
    )


def buckets_of_differences(rare: DataFrame) -> DataFrame:
    """Rows (key, fp, n_grams, old) of members that very many sets have: buckets of the next round.

    ``old``: the centre that ``n_grams`` members are different from.
    """
    many = _crowded(rare).where("many").select("center", "gram")
    return rare.join(many, ["center", "gram"]).select(
        F.xxhash64("center", "gram").alias("key"), "fp", "n_grams", F.col("center").alias("old")
    )


def with_links(links: DataFrame | None, labels: DataFrame | None, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far and the components they make."""
    if links is None:
        return more, components(more)
    if more.isEmpty():
        return links, labels
    links = materialize(links.unionByName(more).distinct(), "links")
    return links, components(links)


def jaccard_groups(docs: DataFrame, *, length: int = WORDS) -> DataFrame:
    """Rows (row_key, doc_id, n_shingles, component, component_id) for ``docs`` (doc_id, text).

    Documents link at a similarity of 0.8 of their n-gram sets; ``component_id`` is the
    smallest doc_id reachable by links, the own one included, ``component`` a number of the
    group, 0 for none. Texts that are NULL, empty or
    blank have no n-gram and link with nothing. ``row_key`` identifies a row by id and text;
    repeated rows and rows with the same set link whatever their ids; NULL ids stay NULL
    unless a linked document has one. Other columns are not read. No rows give no rows.

    Equal sets share a fingerprint and are one set from there on. No link is missed, and no
    bucket of many sets is compared pair by pair (see the head of this module).
    """
    texts = docs.select("doc_id", "text", row_key("doc_id", "text").alias("row_key"))
    described = materialize(describe(texts, length), "shingle_sets")
    members = described.where("kind = 0").select("row_key", "doc_id", "fp", "n")
    common = (
        described.where("kind = 1").groupBy("fp").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "fp").limit(COMMON).collect()
    )
    keys = index_keys(texts.select("text"), length, [(r["fp"], r["n"]) for r in common])
    # A bucket matters if it has two different sets. The rows of those buckets are written;
    # they are few compared with all keys.
    first, last, sets = (F.expr(f"{f} OVER (PARTITION BY key)") for f in ("min(fp)", "max(fp)", "count(*)"))
    shared = materialize(
        keys.select("key", "fp", first.alias("center"), last.alias("_last"), (sets > BUCKET).alias("large"))
        .where("center <> _last").select("key", "fp", "center", "large").distinct(),
        "shared_keys",
    )
    known = described.where("kind = 0 AND n > 0").groupBy("fp").agg(
        F.first("n").alias("n"), F.min("row_key").alias("row_key"), F.max("parity").alias("parity")
    )
    sketches = materialize(shared.select("fp").distinct().join(known, "fp"), "sketches")

    def fitting(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and parity bits allow the similarity."""
        a, b = (
            sketches.select(F.col("fp").alias(name), F.col("n").alias(f"_n{name}"), F.col("parity").alias(f"_bits{name}"))
            for name in ("a", "b")
        )
        return pairs.distinct().join(a, "a").join(b, "b").where(may_be_similar("_na", "_bitsa", "_nb", "_bitsb")).select("a", "b")

    def sets_with(fps: DataFrame, name: str) -> DataFrame:
        """The sets of the given fingerprints, from one document each."""
        rows = fps.distinct().join(sketches.select("fp", "row_key"), "fp").select("row_key").distinct()
        near = texts.join(rows.hint("merge"), "row_key", "left_semi").select("text")
        return materialize(sets_of(near, length).dropDuplicates(["fp"]), f"{name}_sets")

    def verified(pairs: DataFrame, name: str, sets: DataFrame | None) -> DataFrame:
        """Links among the pairs, by their sets."""
        pairs = materialize(fitting(pairs), f"{name}_pairs")
        if sets is None:
            sets = sets_with(pairs.select(F.explode(F.array("a", "b")).alias("fp")), name)
        return materialize(similar_pairs(pairs, sets).distinct(), f"{name}_links")

    buckets = shared.where("NOT large").select("key", "fp", "center").unionByName(
        materialize(
            with_fewer_centers(materialize(with_centers(shared.where("large").select("key", "fp")), "centered")), "large_buckets"
        )
    )
    links, labels, sets = None, None, None
    while buckets is not None:
        star = apart_from_center(buckets, labels).select(F.col("center").alias("a"), F.col("fp").alias("b"))
        links, labels = with_links(links, labels, verified(star, "star", sets))
        # What still lies in different components of one bucket.
        placed = placed_in(buckets, labels)
        sizes = scattered(placed, "key")
        sizes = sizes.select("key", ((F.col("size") > BUCKET) & (F.col("outside") > OUTSIDE)).alias("many"))
        placed = materialize(placed.join(sizes, "key"), "open_buckets")
        few = pairs_of_few(placed.where(~F.col("many")))
        many = placed.where("many").select("center", "fp", "component").distinct()
        buckets, here = None, sets
        if not many.isEmpty():
            if sets is None:
                # Later rounds have no others than these.
                sets = sets_with(many.select("fp").union(many.select("center")), "bucket")
            rare = materialize(rare_differences(many, sets), "differences")
            links, labels = with_links(links, labels, verified(pairs_of_differences(rare, sketches), "differing", sets))
            nearest = materialize(with_nearest_centers(buckets_of_differences(rare)), "centered")
            buckets = materialize(with_fewer_centers(nearest, "old"), "buckets")
            buckets = None if buckets.isEmpty() else buckets
        links, labels = with_links(links, labels, verified(few, "rest", here))
    owned = members.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        # Blank texts have no set in common with anything: each row is its own group.
        "_group", F.when(F.col("n") > 0, F.coalesce("component", "fp"))
    )
    smallest = materialize(owned.where("_group IS NOT NULL").groupBy("_group").agg(F.min("doc_id").alias("_least")), "smallest_ids")
    return owned.join(smallest, "_group", "left").select(
        "row_key",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("_group", F.lit(0)).alias("component"),
        F.coalesce("_least", "doc_id").alias("component_id"),
    )


def row_key(*columns: str):
    """A row's identity: the hash of its id and text."""
    return F.xxhash64(*columns)
