"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and turned onto the principal axes of all vectors, so that
the first coordinates hold most of their length. Vectors are grouped into tiles along the
leading axes; pairs of tiles are compared by the first ``LEAD`` coordinates, where the rest of
a dot product is bounded by the product of the lengths of the two rests. Only pairs that can
still reach the threshold take part in the next step; in the end their cosine is computed
from the vectors as given, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.components import components
from wardflow.llm.columns import keeps_columns
from wardflow.session import materialize

THRESHOLD = 0.95
TILE = 2_000
LEAD = 16
#: Bound of the sample that sets the tiles' borders (any borders give the same result).
BORDER_SAMPLE = 4_000
_SLACK = 1e-9


def moments(vectors: DataFrame) -> np.ndarray:
    """Sum over all vectors of the outer product of the unit vector with itself."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                x = unit(np.stack(batch["embedding"]).astype(np.float64))
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "row": list(total)})

    parts = vectors.select("embedding").mapInPandas(rows, "i int, row array<double>")
    values = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    d = max((r["i"] for r in values), default=-1) + 1
    m = np.zeros((d, d))
    for r in values:
        m[r["i"], r["j"]] = r["v"]
    return (m + m.T) / 2


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def borders(sample: np.ndarray, tiles: int) -> list[tuple[int, float]]:
    """A balanced tree of halvings, each on the axis where its part is widest (in heap order)."""
    depth = max(0, int(np.ceil(np.log2(max(tiles, 1)))))
    nodes: list[tuple[int, float]] = [(0, 0.0)] * ((1 << depth) - 1)
    parts = {0: np.arange(len(sample))}
    for node in range(len(nodes)):
        part = parts.pop(node)
        axis = int(np.argmax(np.var(sample[part], axis=0))) if len(part) else 0
        cut = float(np.median(sample[part, axis])) if len(part) else 0.0
        nodes[node] = (axis, cut)
        right = sample[part, axis] > cut
        parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
    return nodes


def leaf_of(x: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    axes, cuts = np.array([a for a, _ in nodes], np.int64), np.array([c for _, c in nodes])
    for _ in range((len(nodes) + 1).bit_length() - 1):
        at = 2 * at + 1 + (x[np.arange(len(x)), axes[at]] > cuts[at])
    return at - len(nodes)


def compare(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows whose cosine reaches the threshold; i < j within one tile."""
    ua, ub = unit(a) @ axes, unit(b) @ axes
    rest = [np.sqrt(np.maximum((u[:, LEAD:] ** 2).sum(axis=1), 0)) for u in (ua, ub)]
    found_i, found_j = [], []
    for begin in range(0, len(a), 512):
        rows = slice(begin, begin + 512)
        bound = ua[rows, :LEAD] @ ub[:, :LEAD].T + rest[0][rows, None] * rest[1][None, :]
        i, j = np.nonzero(bound >= threshold - _SLACK)
        i += begin
        if same:
            i, j = i[i < j], j[i < j]
        lead = np.einsum("nd,nd->n", ua[i, :LEAD], ub[j, :LEAD]) if len(i) else np.empty(0)
        for end in range(2 * LEAD, ua.shape[1], LEAD):
            lead = lead + np.einsum("nd,nd->n", ua[i, end - LEAD : end], ub[j, end - LEAD : end])
            tail = np.sqrt((ua[i, end:] ** 2).sum(axis=1)) * np.sqrt((ub[j, end:] ** 2).sum(axis=1))
            stays = lead + tail >= threshold - _SLACK
            i, j, lead = i[stays], j[stays], lead[stays]
        dot = np.einsum("nd,nd->n", a[i], b[j])
        exact = dot / (np.sqrt((a[i] ** 2).sum(axis=1)) * np.sqrt((b[j] ** 2).sum(axis=1))) >= threshold
        found_i.append(i[exact])
        found_j.append(j[exact])
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the links that are enough to connect what all links connect."""
    parent, chosen = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            chosen.append(k)
    return np.array(chosen, np.int64)


@keeps_columns("vec_id", "embedding", new=("n_links", "component_id"))
def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vectors`` (vec_id, embedding, others) with n_links and component_id.

    ``n_links`` counts the other rows whose cosine is at least ``threshold``; ``component_id``
    is the smallest vec_id reachable by links, the own one included. Vectors that are NULL,
    empty or zero, or hold NULL or a number that is not finite, link with nothing; vectors
    of another length than most are compared among their own length only. Equal vectors are
    compared once and counted as often as they occur, so a large group of copies is one
    vector; ids may be repeated or NULL (a NULL id is no component's id unless alone).
    No rows give no rows; other columns stay, n_links and component_id are replaced.

    All pairs of tiles that can hold a link are compared, which is quadratic where vectors lie
    close together; each comparison is a task of its own that sends back counts for each
    vector and as many links as connect what it found, never all pairs.
    """
    keep = [c for c in vectors.columns if c not in ("n_links", "component_id")]
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    keyed = vectors.select(
        *keep, F.when(usable, F.xxhash64("embedding", F.lit(0))).alias("_group")
    )
    distinct = keyed.where("_group IS NOT NULL").groupBy("_group", F.size("embedding").alias("_d")).agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("_least")
    )
    distinct = materialize(distinct, "distinct_vectors")
    links, counts = None, None
    for d in sorted(r["_d"] for r in distinct.select("_d").distinct().collect()):
        part = distinct.where(F.col("_d") == d).select("_group", "embedding", "copies")
        found = materialize(tiled(part, threshold, tile), "tile_links")
        links = found if links is None else links.union(found)
    if links is None:
        return keyed.select(*keep, F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    counts = links.groupBy(F.col("a").alias("_node")).agg(F.sum("n").alias("_n"))
    labels = components(links.where("b IS NOT NULL"))
    named = (
        distinct.select("_group", "copies", "_least")
        .join(labels.withColumnRenamed("node", "_group"), "_group", "left")
        .withColumn("_component", F.coalesce("component", "_group"))
        .join(counts.withColumnRenamed("_node", "_group"), "_group", "left")
    )
    smallest = named.groupBy("_component").agg(F.min("_least").alias("_smallest"))
    named = materialize(
        named.join(smallest, "_component").select("_group", (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("_links"), "_smallest"),
        "vector_groups",
    )
    return keyed.join(named, "_group", "left").select(
        *keep, F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_smallest", "vec_id").alias("component_id")
    )


def tiled(vectors: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Rows (a, b, n) for different vectors (_group, embedding, copies) of one length.

    For each vector and comparison ``n`` copies it links with (b is NULL), and links (a, b)
    with n = 0 that connect what was found.
    """
    values, turned = np.linalg.eigh(moments(vectors))
    axes = turned[:, np.argsort(-values)]
    n = vectors.count()
    picked = vectors.orderBy(F.xxhash64("_group", F.lit("borders"))).limit(BORDER_SAMPLE).select("embedding").collect()
    lead = min(LEAD, len(axes))
    nodes = borders((unit(np.array([r["embedding"] for r in picked], np.float64)) @ axes)[:, :lead], -(-n // tile))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = (unit(np.stack(batch["embedding"]).astype(np.float64)) @ axes)[:, :lead]
                yield batch.assign(leaf=leaf_of(x, nodes), lead=list(x))

    placed = vectors.mapInPandas(place, "_group long, embedding array<float>, copies long, leaf long, lead array<double>")
    placed = materialize(placed, "placed_vectors")
    sizes = placed.groupBy("leaf").agg(
        F.count("*").alias("rows"),
        *[f(F.col("lead")[k]).alias(f"{name}{k}") for k in range(lead) for f, name in ((F.min, "low"), (F.max, "high"))],
    ).collect()
    # Leaves are few: one for each ``tile`` vectors. A crowded leaf is dealt to several tiles.
    tiles = [(r, s) for r in sorted(sizes, key=lambda r: r["leaf"]) for s in range(-(-r["rows"] // (2 * tile)))]
    low = np.array([[r[f"low{k}"] for k in range(lead)] for r, _ in tiles])
    high = np.array([[r[f"high{k}"] for k in range(lead)] for r, _ in tiles])
    farthest = 2 - 2 * threshold + _SLACK  # squared distance of unit vectors at the threshold
    pairs = []
    for p in range(len(tiles)):
        gap = np.maximum(np.maximum(low[p] - high[p:], low[p:] - high[p]), 0)
        pairs += [(p, p + int(q)) for q in np.flatnonzero((gap**2).sum(axis=1) <= farthest)]
    spark = vectors.sparkSession
    numbers = spark.createDataFrame([(r["leaf"], s, -(-r["rows"] // (2 * tile)), k) for k, (r, s) in enumerate(tiles)], "leaf long, part int, parts int, tile int")
    wanted = spark.createDataFrame([(k, side, t) for k, pq in enumerate(pairs) for side, t in enumerate(pq) if side == 0 or pq[0] != pq[1]], "pair int, side int, tile int")
    dealt = placed.join(numbers, "leaf").where(F.pmod(F.xxhash64("_group"), F.col("parts")) == F.col("part"))
    sent = dealt.select("_group", "embedding", "copies", "tile").join(wanted, "tile")

    def both(group: pd.DataFrame) -> pd.DataFrame:
        sides = [group[group["side"] == s] for s in (0, 1)]
        same = not len(sides[1])
        one, two = sides[0], sides[0] if same else sides[1]
        a, b = (np.stack(x["embedding"]).astype(np.float64) for x in (one, two))
        i, j = compare(a, b, axes, threshold, same)
        ids = np.concatenate([one["_group"].to_numpy(), two["_group"].to_numpy()])
        copies = np.concatenate([one["copies"].to_numpy(), two["copies"].to_numpy()])
        j_all = j if same else j + len(one)
        linked = np.bincount(i, copies[j_all], len(ids)) + np.bincount(j_all, copies[i], len(ids))
        some = np.flatnonzero(linked)
        tree = forest(i, j_all, len(ids))
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[some], ids[i[tree]]]),
                "b": pd.array([None] * len(some) + ids[j_all[tree]].tolist(), dtype="Int64"),
                "n": np.concatenate([linked[some], np.zeros(len(tree))]).astype(np.int64),
            }
        )

    return sent.groupBy("pair").applyInPandas(both, "a long, b long, n long")
