"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for all ends of links (a, b); component: its smallest node.

    Every node hooks to its smallest neighbour, chains are shortened by pointer
    jumping until they end at a root, links are moved to the roots, and so on
    until none is left. A round at least halves the groups that still grow.
    Each step is an aggregation or join on a narrow table that is written to the
    shared folder, so a lost executor costs one step. Links may be repeated, in
    either direction, or join a node to itself; no links give no rows.
    """
    ends = links.select(F.col("a"), F.col("b"))
    edges = materialize(ends.union(ends.select("b", "a")).distinct(), "links")
    labels = None
    while True:
        hooked = edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root")
        )
        roots = _jumped(materialize(hooked, "hooked"))
        if labels is None:
            labels = roots
        else:
            moved = roots.select(F.col("node").alias("component"), F.col("root").alias("_root"))
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("_root", "component").alias("component")
            )
        labels = materialize(labels.select("node", F.col(labels.columns[-1]).alias("component")), "labels")
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        edges = (
            edges.join(a, "a").join(b, "b").where("_a <> _b")
            .select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
        )
        edges = materialize(edges, "links")
        if edges.isEmpty():
            return labels


def _jumped(parents: DataFrame) -> DataFrame:
    """Every node's root, by replacing parents with their parents until nothing changes."""
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("_above"))
        longer = parents.join(above, "root").where("_above <> root")
        if longer.isEmpty():
            return parents
        parents = materialize(parents.join(above, "root").select("node", F.col("_above").alias("root")), "hooked")
