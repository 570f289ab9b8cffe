"""Hard negatives of anchors, found with bounds along a spanning tree of the anchors.

Scores are integer inner products. The anchors of a block are joined to a spanning tree of
short edges. Where the score of a row with a parent anchor is known to lie in an interval,
its score with the child lies in that interval widened by the length of the edge times the
length of the row (Cauchy-Schwarz), so only rows whose interval overlaps the scores that are
wanted are scored anew; the others hand their wider interval down the tree.

Anchors are a stated share of the rows. They are taken in blocks of bounded size, each of
which is broadcast and meets all rows in one pass over them; a task keeps the best few rows
of each anchor and sends only these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.history import in_slices
from wardflow.session import materialize

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percents of the positive's score.
LOW, HIGH = 50, 95
#: Anchors that are broadcast at a time, and the most bytes that their vectors may take.
BLOCK_ROWS, BLOCK_BYTES = 2_048, 16 << 20
#: Rows that a task compares with a block at a time.
RUN_ROWS = 4_096
#: Share of the rows from which on all are scored by one matrix product.
DENSE = 0.25
LEAST = np.iinfo(np.int64).min


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (id, label, vector) that take part, each component x as floor(256 * x).

    Left out are rows whose id, label or vector is NULL or whose vector has a NULL or
    non-finite component. A component beyond 64 bits is cut to them.
    """
    components = F.col(f"`{vector}`")
    broken = F.exists(components, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & components.isNotNull() & ~broken)
    return kept.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(components, lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    *,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` (id, label, vector of whole numbers); ``is_anchor`` tells anchors by ``id``. An
    anchor's positives are its ``n_positives`` best rows of the same label, other ids only. For
    each, the best ``n_negatives`` rows of other labels are returned whose score lies in
    the window of ``LOW`` to ``HIGH`` percent of the positive's. Higher scores come first, then
    smaller ids. Rows repeating an id are rows of their own, shorter vectors end in zeros, and a
    score beyond 64 bits is cut to them. No anchors or no rows, no result.
    """
    rows = materialize(rows.select("id", "label", "vector"), "vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * width)))
    # Signs of the leading components bring anchors of like direction into one block.
    signs = F.aggregate(F.slice("vector", 1, 16), F.lit(0), lambda code, x: code * 2 + F.when(x < 0, 1).otherwise(0))
    chosen = in_slices(rows.where(is_anchor), "label", [signs, F.col("id")], block_rows)
    chosen = materialize(chosen.withColumnsRenamed({"_place": "anchor", "_slice": "block"}), "anchors")
    blocks = _blocks(chosen, block_rows)
    if not blocks:
        return rows.sparkSession.createDataFrame([], RESULT)

    best = _passes(rows, chosen, blocks, width, lambda block: _Positives(block, n_positives), "anchor long, id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_positives)
    wanted = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    paired = materialize(chosen.join(wanted, "anchor"), "anchors_with_positives")

    found = _passes(rows, paired, blocks, width, lambda block: _Negatives(block, n_negatives), "anchor long, id long, score long, positive int")
    first = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_negatives)
    names = best.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    anchors = chosen.select("anchor", F.col("id").alias("anchor_id"))
    return found.join(names, ["anchor", "positive"]).join(anchors, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _blocks(anchors: DataFrame, most: int) -> list[tuple[int, int]]:
    """First and last slice of each block: neighbouring slices with ``most`` anchors at most."""
    blocks, size = [], most
    for number, count in anchors.groupBy("block").count().orderBy("block").toLocalIterator():
        if size + count > most:
            blocks.append((number, number))
            size = 0
        blocks[-1] = blocks[-1][0], number
        size += count
    return blocks


def _passes(rows: DataFrame, anchors: DataFrame, blocks: Sequence[tuple[int, int]], width: int, search: Callable, schema: str) -> DataFrame:
    """What ``search`` finds for the anchors of each block, one pass over ``rows`` per block.

    At most ``BLOCK_ROWS`` anchors and ``BLOCK_BYTES`` of vectors are on the driver at a time.
    """
    context = rows.sparkSession.sparkContext
    out = []
    for first, last in blocks:
        members = anchors.where(F.col("block").between(first, last)).toArrow()
        if not members.num_rows:
            continue
        sent = context.broadcast(Block.of(members, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            state = search(sent.value)
            for batch in batches:
                for start in range(0, batch.num_rows, RUN_ROWS):
                    state.add(Rows.of(batch.slice(start, RUN_ROWS), width))
            columns = state.result()
            for start in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[start : start + 50_000], pa.int32() if n == "positive" else pa.int64()) for n, c in zip(state.names, columns, strict=True)],
                    names=list(state.names),
                )

        out.append(materialize(rows.mapInArrow(run, schema), "best_rows"))
        sent.unpersist()
    return reduce(DataFrame.unionByName, out) if out else rows.sparkSession.createDataFrame([], schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Whole numbers of a list column, row by row, filled up with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    values = np.asarray(column.flatten())
    if (sizes == width).all():
        return values.reshape(-1, width)
    matrix = np.zeros((len(sizes), width), np.int64)
    matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return matrix


@dataclass
class Rows:
    """Some rows: products of components up to ``limit`` add up exactly in doubles."""

    ids: np.ndarray
    labels: np.ndarray
    whole: np.ndarray
    limit: float = 0.0
    wide: np.ndarray = field(init=False)

    def __post_init__(self):
        self.limit = float(np.sqrt(2.0**52 / max(1, self.whole.shape[1])))
        self.values = self.whole.astype(np.float64)
        self.norms = np.sqrt((self.values**2).sum(axis=1))
        self.wide = (np.abs(self.values) > self.limit).any(axis=1)

    @classmethod
    def of(cls, batch, width: int):
        vectors = batch.column("vector")
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        return cls(np.asarray(batch.column("id")), np.asarray(batch.column("label")), _matrix(vectors, width))


class Block(Rows):
    """Anchors with their keys, trees (one, or one per label) and, in the second phase, positives."""

    @classmethod
    def of(cls, members: pa.Table, width: int):
        block = super().of(members, width)
        block.keys = np.asarray(members.column("anchor"))
        if "positives" in members.column_names:
            block.positives = members.column("positives").to_pylist()
            block.tree = spanning_tree(block.values)
        else:
            block.groups = []
            for label in np.unique(block.labels):
                places = np.flatnonzero(block.labels == label)
                part = Rows(block.ids[places], block.labels[places], block.whole[places])
                block.groups.append((label, places, part, spanning_tree(part.values)))
        return block


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree: (order from the root on, parent or -1, length of the edge to it)."""
    n = len(vectors)
    squares = (vectors**2).sum(axis=1)
    order, parent, edge = np.empty(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, distance, outside = np.full(n, -1), np.full(n, np.inf), np.ones(n, bool)
    at = 0
    for step in range(n):
        order[step], outside[at] = at, False
        parent[at], edge[at] = nearest[at], 0.0 if nearest[at] < 0 else distance[at]
        new = squares + squares[at] - 2 * (vectors @ vectors[at])
        closer = outside & (new < distance)
        distance[closer], nearest[closer] = new[closer], at
        if step < n - 1:
            at = int(np.where(outside, distance, np.inf).argmin())
    # Taken anew, without the cancellation of the expanded square.
    has = parent >= 0
    edge[has] = np.sqrt(((vectors[has] - vectors[parent[has]]) ** 2).sum(axis=1))
    return order, parent, edge


def descend(block: Rows, tree, rows: Rows, wanted: Callable[[int], tuple[float, float]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, places of rows, their scores) down the tree, for rows that may be wanted.

    ``wanted`` gives the least and largest score that an anchor has use for, and is asked
    when the anchor's turn comes. Rows or anchors too wide for exact sums in doubles are scored
    one by one in whole numbers of any size.
    """
    order, parent, edge = tree
    easy, hard = np.flatnonzero(~rows.wide), np.flatnonzero(rows.wide)
    values, norms = rows.values[easy], rows.norms[easy]
    middle = np.zeros((len(order), len(easy)))
    slack = np.zeros_like(middle)
    # Rounding of bounds: far above that of sums of doubles, far below a point of score.
    ease = 1.0 + 1e-9
    for a in order:
        least, most = wanted(a)
        over = parent[a]
        if block.wide[a]:
            middle[a], slack[a] = 0.0, np.inf
            if least <= most:
                yield a, np.arange(len(rows.ids)), _long_scores(rows.whole, block.whole[a])
            continue
        if over < 0:
            spread = np.full(len(easy), np.inf)
        else:
            spread = slack[over] + (edge[a] * ease) * norms + 1.0
        near = (middle[over] + spread >= least) & (middle[over] - spread <= most) if over >= 0 else np.ones(len(easy), bool)
        if over < 0 or near.mean() >= DENSE:
            middle[a] = values @ block.values[a]
            slack[a] = 0.0
            places = np.flatnonzero(near)
        else:
            places = np.flatnonzero(near)
            middle[a], slack[a] = middle[over], spread
            middle[a, places] = values[places] @ block.values[a]
            slack[a, places] = 0.0
        scores = middle[a, places]
        fits = (scores >= least) & (scores <= most)
        found, scores = easy[places[fits]], scores[fits].astype(np.int64)
        if len(hard) and least <= most:
            found = np.concatenate([found, hard])
            scores = np.concatenate([scores, _long_scores(rows.whole[hard], block.whole[a])])
        yield a, found, scores


def _long_scores(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    exact = (vectors.astype(object) * anchor.astype(object)).sum(axis=1)
    top = np.iinfo(np.int64).max
    return np.array([max(LEAST, min(top, int(s))) for s in exact], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, then smallest ids."""
    if len(scores) > 4 * n:
        bar = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= bar)
        return some[_best(scores[some], ids[some], n)] if len(some) < len(scores) else np.lexsort((ids, ~scores))[:n]
    return np.lexsort((ids, ~scores))[:n]  # ~s falls as s grows, also at the least number


class _Positives:
    """The best rows of each anchor's own label among the rows seen."""

    names = ("anchor", "id", "score")

    def __init__(self, block: Block, n: int):
        self.block, self.n = block, n
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in block.ids]

    def add(self, rows: Rows) -> None:
        for label, members, part, tree in self.block.groups:
            same = np.flatnonzero(rows.labels == label)
            if not len(same):
                continue
            own = Rows(rows.ids[same], rows.labels[same], rows.whole[same])

            def wanted(a, members=members):
                scores, _ = self.found[members[a]]
                return (float(scores.min()) if len(scores) == self.n else -np.inf), np.inf

            for a, places, scores in descend(part, tree, own, wanted):
                other = own.ids[places] != part.ids[a]
                self._merge(members[a], scores[other], own.ids[places][other])

    def _merge(self, a: int, scores: np.ndarray, ids: np.ndarray) -> None:
        before = self.found[a]
        scores, ids = np.concatenate([before[0], scores]), np.concatenate([before[1], ids])
        best = _best(scores, ids, self.n)
        self.found[a] = scores[best], ids[best]

    def result(self):
        sizes = [len(ids) for _, ids in self.found]
        return (
            np.repeat(self.block.keys, sizes),
            np.concatenate([ids for _, ids in self.found]),
            np.concatenate([scores for scores, _ in self.found]),
        )


class _Negatives:
    """For each positive of each anchor, the best rows of other labels in its window."""

    names = ("anchor", "id", "score", "positive")

    def __init__(self, block: Block, n: int):
        self.block, self.n = block, n
        top = np.iinfo(np.int64).max
        self.windows = [
            [
                (p["rank"], low, high)
                for p in positives
                # Smallest and largest whole score in the window; scores go up to 64 bits.
                if (low := -(-LOW * p["score"] // 100)) <= (high := min(top, HIGH * p["score"] // 100))
            ]
            for positives in block.positives
        ]
        nothing = np.empty(0, np.int64), np.empty(0, np.int64)
        self.found = [{rank: nothing for rank, _, _ in windows} for windows in self.windows]

    def _from(self, a: int, rank: int, low: int) -> int:
        scores, _ = self.found[a][rank]
        return max(low, int(scores.min())) if len(scores) == self.n else low

    def add(self, rows: Rows) -> None:
        def wanted(a):
            windows = self.windows[a]
            if not windows:
                return np.inf, -np.inf
            return float(min(self._from(a, r, low) for r, low, _ in windows)), float(max(high for _, _, high in windows))

        for a, places, scores in descend(self.block, self.block.tree, rows, wanted):
            other = rows.labels[places] != self.block.labels[a]
            places, scores = places[other], scores[other]
            for rank, low, high in self.windows[a]:
                inside = (scores >= self._from(a, rank, low)) & (scores <= high)
                if inside.any():
                    before = self.found[a][rank]
                    s = np.concatenate([before[0], scores[inside]])
                    ids = np.concatenate([before[1], rows.ids[places[inside]]])
                    best = _best(s, ids, self.n)
                    self.found[a][rank] = s[best], ids[best]

    def result(self):
        flat = [(key, rank, *got) for key, ranks in zip(self.block.keys, self.found, strict=True) for rank, got in ranks.items()]
        sizes = [len(ids) for *_, ids in flat]
        if not flat:
            return tuple(np.empty(0, np.int64) for _ in self.names)
        return (
            np.repeat([key for key, *_ in flat], sizes),
            np.concatenate([ids for *_, ids in flat]),
            np.concatenate([scores for _, _, scores, _ in flat]),
            np.repeat([rank for _, rank, _, _ in flat], sizes),
        )
