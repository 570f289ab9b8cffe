"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations that begin with the same turns share a path of nodes from the root. Totals
of subtrees are not added up level by level, which would take as many steps as the longest
conversation has turns, but over the forest of edges to parents: every tree is split at its
centroid, the totals of the parts below a centroid are added to the nodes on the path from
the centroid to the top of its part, and the parts are split again. The parts halve, so a
node takes part in a logarithmic number of steps, whatever the shape of the trie.

Trees of more than ``PART`` nodes are split by joins over the whole cluster; parts that
have come below that size are finished inside tasks, many parts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.mixing import word_count
from wardflow.operators.history import ROWS_PER_SLICE, in_slices, split_long_groups
from wardflow.session import materialize

#: Nodes of a part that one task finishes.
PART = 1_024
#: Characters of a list of ids that are passed on as one row.
ID_CHUNK = 1 << 16

#: Key of the root, which no turn leads to.
ROOT = "named_struct('k1', 0L, 'k2', 0L)"


def ordered_turns(conversations: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Rows (conv_id, place, d1, d2, words): turns numbered from 1 within a conversation.

    Order: ``turn`` (NULL first), then a digest of role and text. NULL role or text counts
    as empty, rows without ``conv_id`` are left out, repeated rows are turns of their own.
    Two 60-bit halves of an MD5 digest stand for a turn's role and text from here on. A
    conversation of more than ``rows_per_slice`` turns is numbered slice by slice.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), word_count(text).alias("words")
    )
    order = [F.col("turn"), F.col("digest")]
    short, long = split_long_groups(turns, "conv_id", rows_per_slice)
    numbered = short.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    if long is not None:
        in_slice = Window.partitionBy("conv_id", "_slice").orderBy("_place")
        cut = materialize(
            in_slices(long, "conv_id", order, rows_per_slice).withColumn("place", F.row_number().over(in_slice).cast("long")),
            "sliced_turns",
        )
        earlier = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        before = cut.groupBy("conv_id", "_slice").agg(F.count("*").alias("n")).select(
            "conv_id", "_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
        )
        numbered = numbered.unionByName(
            cut.join(before, ["conv_id", "_slice"]).select(*turns.columns, (F.col("place") + F.col("before")).alias("place"))
        )
    halves = [F.conv(F.substring("digest", start, 15), 16, 10).cast("long") for start in (1, 17)]
    return numbered.select("conv_id", "place", halves[0].alias("d1"), halves[1].alias("d2"), "words")


def with_shared_heads(turns: DataFrame, source: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one: (conversations, turns).

    The first ``heads`` turns (0 to ``most``) of each conversation are replaced by as many
    of conversation ``source`` (all if it has fewer, none if it does not exist). Both are
    columns of ``conv_id``. The first result has a row for every conversation, also those
    left without a turn.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("length"))
    convs = materialize(lengths.select("conv_id", "length", source.alias("source"), heads.cast("long").alias("heads")), "conversations")
    givers = convs.select(F.col("conv_id").alias("source"), F.col("length").alias("given"))
    convs = convs.join(givers, "source", "left").withColumn("given", F.least("heads", F.coalesce("given", F.lit(0))))
    first = turns.where(F.col("place") <= most).withColumnRenamed("conv_id", "source")
    taken = convs.where("given > 0").join(first, "source").where("place <= given").select(*turns.columns)
    replaced = convs.select("conv_id", "heads", "given")
    own = turns.join(replaced, "conv_id").where("place > heads").select(
        "conv_id", (F.col("place") - F.col("heads") + F.col("given")).alias("place"), "d1", "d2", "words"
    )
    return convs.select("conv_id"), taken.unionByName(own)


def prefixes(turns: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Rows (conv_id, place, node, parent, words): the node that each turn leads to.

    A node's key joins 120 bits of hashes of every (place, turn) up to it by exclusive or,
    which can be taken over slices of a long conversation one by one.
    """
    salted = turns.select(
        "conv_id", "place", "words",
        F.xxhash64("place", "d1", "d2").alias("x1"), F.xxhash64("d2", "place", "d1").alias("x2"),
        F.expr(f"place div {int(rows_per_slice)}L").alias("slice"),
    )
    upto = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    found = materialize(
        salted.select("*", *[F.bit_xor(x).over(upto).alias(k) for x, k in (("x1", "k1"), ("x2", "k2"))]), "prefixes"
    )
    if not found.where("slice > 0").isEmpty():
        earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        totals = found.groupBy("conv_id", "slice").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
        before = totals.select("conv_id", "slice", *[F.coalesce(F.bit_xor(t).over(earlier), F.lit(0)).alias(b) for t, b in (("t1", "b1"), ("t2", "b2"))])
        found = found.join(before, ["conv_id", "slice"]).withColumns(
            {k: F.col(k).bitwiseXOR(F.col(b)) for k, b in (("k1", "b1"), ("k2", "b2"))}
        )
    above = F.struct(*[F.col(k).bitwiseXOR(F.col(x)).alias(k) for k, x in (("k1", "x1"), ("k2", "x2"))])
    return found.select(
        "conv_id", "place", F.struct("k1", "k2").alias("node"), F.when(F.col("place") > 1, above).otherwise(F.expr(ROOT)).alias("parent"), "words"
    )


def prefix_trie(convs: DataFrame, turns: DataFrame, *, part: int = PART, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv_id, place from 1, d1, d2, words).

    ``convs`` holds every conversation once, also those without turns, which end at the
    root. Result: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens over the subtree, ends_sha256. No conversations, no rows.
    """
    paths = materialize(prefixes(turns, rows_per_slice), "paths")
    found = materialize(
        paths.groupBy("node", "parent", F.col("place").alias("depth")).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words")
        ),
        "nodes",
    )
    children = found.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    inner = materialize(
        found.join(children, "node", "left").select(
            *found.columns,
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "weighed_nodes",
    )
    totals = subtree_totals(inner, paths, part)
    zero = F.lit(0).cast("long")
    counted = convs.select("conv_id", F.lit(1).cast("long").alias("n"), zero.alias("child"), zero.alias("leaf"), zero.alias("saved")).unionByName(
        inner.select(F.lit(None).cast("long").alias("conv_id"), zero.alias("n"), (F.col("depth") == 1).cast("long").alias("child"), "leaf", "saved")
    )
    root = counted.agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("child").alias("n_children"),
        F.greatest(F.sum("leaf"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    ).where("n_convs > 0")
    root = root.select(
        F.expr(ROOT).alias("node"), "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
    )
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    top = root.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    nodes = (
        inner.join(totals, "node").join(above.unionByName(top), "parent")
        .select("node", "conv_id", "depth", F.col("_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
        .unionByName(root)
    )
    last = paths.groupBy("conv_id").agg(F.max_by("node", "place").alias("node"))
    ends = convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("node", F.expr(ROOT)).alias("node"))
    return nodes.join(ends_digest(ends), "node", "left").select(
        *nodes.columns[1:], F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """Rows (node, ends_sha256) of rows (node, conv_id): digest of the ascending ids, comma-joined.

    Ids are sorted over all tasks and joined to texts of ``ID_CHUNK`` characters there, so
    that a node at which very many conversations end sends few rows to the one task that
    must read them in order; that task keeps a digest, not the ids.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0
        done: list[tuple] = []
        for batch in batches:
            for k1, k2, conv in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "conv_id")], strict=True):
                if (k1, k2) != node or size > ID_CHUNK:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    node, first, ids, size = (k1, k2), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["k1", "k2", "first", "ids"])
                done = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, first, ",".join(ids))], names=["k1", "k2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["k1", "k2", "ends_sha256"])

        node, state, done = None, None, []
        for batch in batches:
            for k1, k2, ids in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "ids")], strict=True):
                if (k1, k2) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (k1, k2), hashlib.sha256(ids.encode())
            if done:
                yield out(done)
                done = []
        if node is not None:
            yield out([(*node, state.hexdigest())])

    dealt = ends.select("node.k1", "node.k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    pieces = dealt.mapInArrow(joined, "k1 long, k2 long, first long, ids string")
    digests = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")
    return digests.select(F.struct("k1", "k2").alias("node"), "ends_sha256")


def subtree_totals(nodes: DataFrame, paths: DataFrame, part: int = PART) -> DataFrame:
    """Rows (node, n_leaves, saved_tokens): sums of leaf and saved over every subtree.

    ``nodes`` (node, parent, depth, conv_id, leaf, saved) form trees with tops at depth 1;
    ``paths`` (conv_id, place, node, parent) gives the ancestors of a node through the
    conversation that represents it. Trees of more than ``part`` nodes are split first.
    """
    tops = paths.where("place = 1").select("conv_id", F.col("node").alias("tree"))
    state = materialize(
        nodes.join(tops, "conv_id").select("node", "parent", "depth", "conv_id", "leaf", "saved", "tree"), "forest"
    )
    large = materialize(state.groupBy("tree").count().where(F.col("count") > part).select("tree"), "large_trees")
    columns = ["node", "parent", "leaf", "saved", "tree"]
    if large.isEmpty():
        return _finished(state.select(columns))
    parts = [state.join(large, "tree", "left_anti").select(columns)]
    added = []
    state = _with_sizes(state.join(large, "tree", "left_semi"), paths).withColumn("top", F.lit(1).cast("long"))
    while True:
        state = materialize(state, "split_trees")
        sized = state.groupBy("tree").agg(F.max("size").alias("nodes"))
        parts.append(state.join(sized.where(F.col("nodes") <= part), "tree", "left_semi").select(columns))
        state = materialize(state.join(sized.where(F.col("nodes") > part), "tree"), "large_trees")
        if state.isEmpty():
            break
        state, more = _split(state, paths)
        added.append(more)
    found = _finished(reduce(DataFrame.unionByName, parts))
    every = reduce(DataFrame.unionByName, [found, *added])
    return every.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _with_sizes(state: DataFrame, paths: DataFrame) -> DataFrame:
    """Add ``size``, the nodes of each subtree, in a logarithmic number of rounds.

    After round k a node has counted what lies less than 2**k below it.
    """
    state = materialize(state.withColumn("size", F.lit(1).cast("long")), "sizes")
    deepest = state.agg(F.max("depth")).first()[0]
    steps = paths.select("conv_id", F.col("place").alias("_at"), F.col("node").alias("_up"))
    hop = 1
    while hop < deepest:
        below = state.where(F.col("depth") > hop).withColumn("_at", F.col("depth") - hop)
        more = below.join(steps, ["conv_id", "_at"]).groupBy(F.col("_up").alias("node")).agg(F.sum("size").alias("_more"))
        state = materialize(
            state.join(more, "node", "left").withColumn("size", F.col("size") + F.coalesce("_more", F.lit(0))).drop("_more"), "sizes"
        )
        hop *= 2
    return state


def _split(state: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut every tree at its centroid: (smaller trees, what the paths to the tops get)."""
    # Subtrees of half the nodes or more lie on one path; the smallest of them is the centroid's.
    half = state.where("2 * size >= nodes").groupBy("tree").agg(
        F.min_by(F.struct("node", "depth", "conv_id", "size"), "size").alias("c"), F.first("top").alias("top")
    )
    centroids = materialize(half, "centroids")
    marked = state.drop("top", "nodes").join(centroids, "tree")
    steps = paths.select("conv_id", F.col("place").alias("_at"), F.col("node").alias("_child"), F.col("parent").alias("_over"))
    marked = (
        marked.withColumn("_at", F.when(F.col("depth") > F.col("c.depth"), F.col("c.depth") + 1))
        .join(steps, ["conv_id", "_at"], "left")
        .withColumn("_child", F.when(F.col("_over") == F.col("c.node"), F.col("_child")))
        .drop("_over", "_at")
    )
    marked = materialize(marked, "marked_trees")
    under = F.col("_child").isNotNull() | (F.col("node") == F.col("c.node"))
    sums = marked.where(under).groupBy("tree").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    climbed = (
        centroids.join(sums, "tree")
        .select("top", F.col("c.conv_id").alias("conv_id"), F.col("c.depth").alias("_low"), F.col("c.size").alias("_size"), "n_leaves", "saved_tokens")
        .join(paths.select("conv_id", "place", "node"), "conv_id")
        .where("place BETWEEN top AND _low")
    )
    climbed = materialize(climbed.select("node", "_size", "n_leaves", "saved_tokens"), "climbed")
    rest = (
        marked.where(F.col("node") != F.col("c.node"))
        .join(climbed.select("node", "_size"), "node", "left")
        .select(
            "node", "parent", "depth", "conv_id", "leaf", "saved",
            F.coalesce("_child", "tree").alias("tree"),
            (F.col("size") - F.coalesce("_size", F.lit(0))).alias("size"),
            F.when(F.col("_child").isNotNull(), F.col("c.depth") + 1).otherwise(F.col("top")).alias("top"),
        )
    )
    return rest, climbed.drop("_size")


def _finished(parts: DataFrame) -> DataFrame:
    """Totals of parts that fit a task, many parts in one pass of numpy."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            frame = batch.to_pandas()
            waiting = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            if len(waiting) < 50_000:
                continue
            # Rows are sorted by part: all but the last one are whole.
            t1, t2 = waiting["t1"].to_numpy(), waiting["t2"].to_numpy()
            whole = (t1 != t1[-1]) | (t2 != t2[-1])
            if whole.any():
                yield summed(waiting[whole])
                waiting = waiting[~whole]
        if waiting is not None and len(waiting):
            yield summed(waiting)

    def summed(frame: pd.DataFrame) -> pa.RecordBatch:
        keys = pd.MultiIndex.from_arrays([frame["k1"], frame["k2"]])
        up = keys.get_indexer(pd.MultiIndex.from_arrays([frame["p1"], frame["p2"]]))
        totals = centroid_totals(up, frame[["leaf", "saved"]].to_numpy(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (frame["k1"], frame["k2"], totals[:, 0], totals[:, 1])], names=["k1", "k2", "n_leaves", "saved_tokens"]
        )

    flat = parts.select(
        "node.k1", "node.k2", F.col("parent.k1").alias("p1"), F.col("parent.k2").alias("p2"),
        "leaf", "saved", F.col("tree.k1").alias("t1"), F.col("tree.k2").alias("t2"),
    )
    found = flat.repartition("t1", "t2").sortWithinPartitions("t1", "t2").mapInArrow(rows, "k1 long, k2 long, n_leaves long, saved_tokens long")
    return found.select(F.struct("k1", "k2").alias("node"), "n_leaves", "saved_tokens")


def centroid_totals(up: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` (node x measure) over the subtree of every node of a forest.

    ``up`` holds each node's parent, -1 at a top. All trees are split at their centroids at
    the same time, round by round, until every node has been a centroid.
    """
    n = len(up)
    every = np.arange(n)
    totals = np.zeros_like(weights)
    left = np.ones(n, bool)  # nodes that no round has taken out yet
    inner = up.copy()  # parent within the present part, -1 at its top
    size = _sizes(up)
    while left.any():
        # The top of each node's part, by jumping over ever longer stretches.
        top = np.where(inner >= 0, inner, every)
        while True:
            further = top[top]
            if (further == top).all():
                break
            top = further
        nodes = every[left]
        half = nodes[2 * size[nodes] >= size[top[nodes]]]
        order = half[np.lexsort((size[half], top[half]))]
        centroid = order[np.append(True, top[order][1:] != top[order][:-1])]
        is_centroid = np.zeros(n, bool)
        is_centroid[centroid] = True
        # Parts below a centroid: the children's edges are cut, and their nodes get new tops.
        child = left & (inner >= 0)
        child[child] = is_centroid[inner[child]]
        over = np.where(child, inner, -1)
        inner[child] = -1
        top = np.where(inner >= 0, inner, every)
        while True:
            further = top[top]
            if (further == top).all():
                break
            top = further
        part = np.zeros_like(weights)
        np.add.at(part, top[left], weights[left])
        gained = weights[centroid].copy()
        place = np.full(n, -1)
        place[centroid] = np.arange(len(centroid))
        children = every[child]
        np.add.at(gained, place[over[children]], part[children])
        # Up the paths from the centroids to the tops, one step in all parts at a time.
        totals[centroid] += gained
        at, lost = inner[centroid], size[centroid]
        while True:
            on = at >= 0
            if not on.any():
                break
            at, lost, gained = at[on], lost[on], gained[on]
            totals[at] += gained  # the paths lie in different parts
            size[at] -= lost
            at = inner[at]
        inner[centroid] = -1
        left[centroid] = False
    return totals


def _sizes(up: np.ndarray) -> np.ndarray:
    """Nodes of every subtree, by doubling the distance that has been counted."""
    size, hop = np.ones(len(up), np.int64), up.copy()
    while (hop >= 0).any():
        has = hop >= 0
        more = np.zeros_like(size)
        np.add.at(more, hop[has], size[has])
        size = size + more
        hop = np.where(has, hop[hop], -1)
    return size
