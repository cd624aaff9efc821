"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icegrid.operators.skew import attach
from icegrid.session import cut_lineage

# Links that one task contracts, about. With fewer in all, one task sees the whole graph.
TASK_LINKS = 500_000
# Links that a task gathers at least before it contracts them.
GATHER = 1 << 16


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component) of the links u, v."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return nodes, nodes[root]
        # every root points to the smallest root it is linked with, then all paths are cut short
        np.minimum.at(root, x, y)
        np.minimum.at(root, y, x)
        while (root[root] != root).any():
            root = root[root]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one partition as a link from each node to its smallest."""
    u = v = np.zeros(0, np.int64)
    rest: list[pd.DataFrame] = []
    held = 0
    # as many links as are known already are gathered, so all sorts together are n log n
    for batch in chain(batches, [None]):
        if batch is not None:
            rest.append(batch)
            held += len(batch)
            if held < max(GATHER, len(u)):
                continue
        nodes, root = forest(np.concatenate([u, *(b["u"].to_numpy(np.int64) for b in rest)]),
                             np.concatenate([v, *(b["v"].to_numpy(np.int64) for b in rest)]))
        u, v = nodes[nodes != root], root[nodes != root]
        rest, held = [], 0
    yield pd.DataFrame({"u": u, "v": v})


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node and root (the smallest node reachable) of every node with a link; links are u, v.

    Tasks of about task_links links, dealt by both ends so that a hub's are spread, first shrink
    theirs to stars. If there are several tasks, large and small stars alternate then: each round
    points the larger neighbours of a node, then the node and its smaller ones, at the smallest
    neighbour, until nothing moves; rounds grow with the logarithm of the number of nodes.
    Minima combine before the shuffle, and a hub's links are joined so that Spark can split them.
    Each round is checkpointed; nothing but a count and a digest reaches the driver. Runs jobs.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = links.where("u <> v").distinct()
    tasks = -(-links.count() // task_links)
    if tasks > 1:
        links = links.repartition(tasks, "u", "v")
    else:
        links = links.repartition(1)
    links = cut_lineage(links.mapInPandas(_contract, "u long, v long"))
    seen = _digest(links) if tasks > 1 else None
    while tasks > 1:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = attach(both, low, ["u"], "inner").where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = attach(large, low, ["u"], "inner")
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = cut_lineage(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        now = _digest(links)
        if now == seen:
            break
        seen = now
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _digest(links: DataFrame) -> tuple[int, int | None]:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
