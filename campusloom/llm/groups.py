"""Connected components of a table of edges, and of small arrays of edges inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import looked_up
from .shared import cut


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By node 0..n-1 the smallest node of its component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (further := label[label] != label).any():
            label[further] = label[label[further]]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of edges (a, b), the smallest node of its component.

    Each round, the label of every edge's end hooks on to the smallest label that it meets, then
    labels of labels are followed. Edges inside a component drop out, so rounds shrink. Their
    number grows with the logarithm of the longest path. Each round is a table in the shared folder.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label")), "labels")
    live = edges
    while not live.isEmpty():
        hook = live.groupBy(F.col("b").alias("_from")).agg(F.min("a").alias("_to"))
        jump = cut(_flatten(hook), "jumps")
        labels = cut(_followed(labels, "label", jump, "node"), "labels")
        both = _followed(_followed(live, "a", jump, "b"), "b", jump, "a")
        live = both.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        live = cut(live, "edges")
    return labels


def _followed(rows: DataFrame, column: str, jump: DataFrame, by: str) -> DataFrame:
    """rows with `column` replaced by where it hooks on; many rows may share its value."""
    found = looked_up(rows, [column], jump.select(F.col("_from").alias(column), F.col("_to").alias("_up")), by)
    return found.withColumn(column, F.coalesce("_up", column)).select(*rows.columns)


def _flatten(hook: DataFrame) -> DataFrame:
    """Follows _to where it hooks on itself; every _to is smaller than its _from, so two steps shorten a chain fourfold."""
    for _ in range(2):
        hook = cut(hook, "hooks")
        hook = _followed(hook, "_to", hook, "_from")
    return hook
