"""Connected components of a graph of links: forests within tasks, then alternating large and small stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Links that one task takes at least: few links need few tasks, many links get as many as it takes.
TASK_LINKS = 50_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component among these links) for every node that is not the smallest itself."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)  # roots meet, and with them all that hangs on them
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, replaced by a forest of stars that connects the same nodes; at most TASK_LINKS wait at once."""
    waiting: list[np.ndarray] = []

    def stars() -> pa.RecordBatch:
        u, v = forest(*np.concatenate(waiting, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for b in batches:
        waiting.append(np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("u", "v")]))
        if sum(x.shape[1] for x in waiting) >= 2 * TASK_LINKS:
            yield stars()
            waiting = []
    if waiting:
        yield stars()


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    return both.where("v > u").join(least, "u").coalesce(tasks).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, goes to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
    moved = edges.join(least, "u").coalesce(tasks).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link but the smallest of its component; component is that smallest node.

    Links are pairs of longs; loops, repeats and direction do not matter, no links give no rows. Each task first
    contracts its own links to stars, then nodes that several tasks hold meet in a large and a small star; only minima
    are gathered per node, never a node's list of neighbours. Tasks are as many as the links need. Each round is cut to
    the shared folder, until one changes nothing.
    """
    edges = cut(links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v"))
    before, n = None, edges.count()
    while True:
        tasks = n // TASK_LINKS + 1
        edges = edges.coalesce(tasks).mapInArrow(_forests, "u long, v long")
        if tasks > 1:
            edges = _small_star(_large_star(cut(edges.distinct().coalesce(tasks)), tasks), tasks).distinct().coalesce(tasks)
        edges = cut(edges)
        n, *state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tasks == 1 or (n, *state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = (n, *state)
