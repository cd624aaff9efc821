"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within a cell.

A vector is at home in the cell of its nearest centre and also present in every cell that one
of its neighbours may be at home in. The great circle that parts two cells is at the angle
asin(x.(c1 - c2) / |c1 - c2|) from x, so a cell further away than the angle of the threshold
cannot hold a neighbour. Every link is therefore found, whatever the centres are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.llm.graph import components
from icegrid.operators.skew import BROADCAST_KEYS, attach
from icegrid.session import by_group, cut_lineage, stored

# Vectors that the centres are fitted on, about, and passes over them.
FIT_VECTORS = 20_000
ROUNDS = 10
# Vectors per cell aimed at, and the most cells.
CELL_ROWS = 8192
CELLS = 1024
# Largest side of a block of products, in bytes of its vectors in double precision.
BLOCK_BYTES = 1 << 24
# Bytes of vectors that are dealt to blocks at once: so many, or as many as all vectors have twice.
ROUND_BYTES = 1 << 30


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and all components finite numbers."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares stay in range."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    if not len(x):
        return x.reshape(0, 1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(vectors: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Spherical k-means: centres are normalised sums of the vectors nearest to them."""
    rng = np.random.default_rng(seed)
    k = min(k, len(vectors))
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        near = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return np.unique(centres, axis=0)


def cells_of(vectors: np.ndarray, centres: np.ndarray, threshold: float) -> list[np.ndarray]:
    """Cells of each unit vector: its home first, then those in reach of the threshold."""
    reach = math.sin(math.acos(threshold)) + 1e-9
    score = vectors @ centres.T
    home = score.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    margin = score[np.arange(len(vectors)), home][:, None] - score
    near = margin <= reach * apart[home]
    near[np.arange(len(vectors)), home] = False
    return [np.append(h, np.flatnonzero(n)) for h, n in zip(home, near, strict=True)]


def _fitted(nodes: DataFrame, threshold: float) -> dict[int, np.ndarray]:
    """Centres by dimension, from a bounded sample chosen by hash."""
    sizes = {r["dim"]: (r["n"], r["labels"]) for r in nodes.groupBy("dim").agg(
        F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).collect()}
    out = {}
    for dim, (n, labels) in sizes.items():
        k = max(1, min(CELLS, math.ceil(n / CELL_ROWS / max(1, math.sqrt(labels)) * 2)))
        rows = nodes.where(F.col("dim") == dim)
        if n > FIT_VECTORS:
            share = int(FIT_VECTORS / n * (1 << 32))
            rows = rows.where(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 32)) < share)
        sample = _unit([r[0] for r in rows.select("vector").collect()]) if k > 1 else None
        out[dim] = fit_centres(sample, k) if k > 1 and len(sample) else np.zeros((1, dim))
    return out


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label",
                 block: int | None = None) -> DataFrame:
    """Links and component of each vector; rows are compared within a label and a length.

    Returns one row per row: id_col, n_links (other rows with cosine >= threshold, in double
    precision), component_id (smallest id reachable by links, itself included) and kept (id =
    component_id). Null, empty, zero and non-finite vectors and null labels link with nothing.
    Equal vectors are one node with a count, so copies are never paired. Rows that repeat an id
    count as rows and share their component. A null id counts for nothing while its component
    has another. Columns other than the three are not read. Runs jobs.

    A large cell is cut into blocks by hash, and each pair of blocks is one group, so no group
    has more than about 2 x block rows (by default those of BLOCK_BYTES). A group reports counts
    and the components it sees, not its pairs. All links are found (see above).
    A vector goes to every pair of blocks it is in. The pairs are dealt out in rounds, each of which
    shuffles a bounded number of copies that are gone before the next, however many pairs there are.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"),
                          F.col(label_col).alias("label"))
    good = usable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.withColumn("node", F.when(good, F.xxhash64("label", "vector")))
    nodes = rows.where("node is not null").groupBy("node", "label").agg(
        F.count("*").alias("copies"), F.first("vector").alias("vector"))
    nodes = stored(nodes.withColumn("dim", F.size("vector")), "vectors")
    centres = _fitted(nodes, threshold)
    placed = stored(nodes.select("node", "label", "dim", "copies", "vector",
                                 _assign(centres, threshold)("dim", "vector").alias("cells")), "cells")
    spread = placed.select("*", F.posexplode("cells").alias("order", "cell")).drop("cells")
    spread = spread.withColumn("home", F.col("order") == 0).drop("order")
    keys = ["label", "dim", "cell"]
    most = F.greatest(F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim"))), F.lit(256)) if block is None else F.lit(block)
    counts = spread.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("home"), 1)).alias("at_home"))
    counts = cut_lineage(counts.withColumn("blocks", F.ceil(F.col("n") / most).cast("int")))
    rounds = _rounds(counts)
    sizes = counts.select(*keys, "blocks")
    units = attach(spread, F.broadcast(sizes) if counts.count() <= BROADCAST_KEYS else sizes, keys, "inner")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    units = units.withColumn("own", own)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # as one that is compared with: all home blocks; as one at home: all other blocks
    seen = F.transform(every, lambda i: F.struct(i.alias("h"), F.col("own").alias("p")))
    asks = F.transform(F.filter(every, lambda i: i != F.col("own")),
                       lambda i: F.struct(F.col("own").alias("h"), i.alias("p")))
    part = F.when(F.col("home"), F.concat(seen, asks)).otherwise(seen)
    found = None
    for k in range(rounds):
        now = lambda u: F.pmod(F.xxhash64(*keys, u["h"], u["p"], F.lit(11)), F.lit(rounds)) == k  # noqa: E731, B023
        dealt = units.withColumn("unit", F.explode(part if rounds == 1 else F.filter(part, now)))
        dealt = dealt.select(*keys, "unit.h", "unit.p", "own", "home", "node", "copies", "vector")
        some = cut_lineage(by_group(dealt, [*keys, "h", "p"]).groupBy(*keys, "h", "p").applyInPandas(
            _comparer(threshold), "node long, links long, root long"))
        found = some if found is None else found.unionByName(some)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("node <> root").select(F.col("node").alias("u"),
                                                          F.col("root").alias("v")))
    named = attach(attach(rows.select("id", "node"), nodes.select("node", "copies"), ["node"]),
                   links, ["node"])
    named = attach(named, roots, ["node"])
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    out = attach(named, least, ["root"])
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    total = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies"), F.lit(1)) - 1
    return out.select(F.col("id").alias(id_col), total.cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component)
                      .alias("kept"))


def _rounds(counts: DataFrame) -> int:
    """Rounds in which the copies of the vectors are dealt out, from the cells' counts."""
    row, blocks = F.lit(4) * F.col("dim") + 64, F.col("blocks")
    copies = F.col("at_home") * (2 * blocks - 1) + (F.col("n") - F.col("at_home")) * blocks
    total, once = counts.agg(F.sum(copies * row), F.sum(F.col("at_home") * row)).first()
    return max(1, math.ceil((total or 0) / max(ROUND_BYTES, 2 * (once or 0))))


def _assign(centres: dict[int, np.ndarray], threshold: float):
    @F.pandas_udf("array<int>")
    def assign(dims: pd.Series, vectors: pd.Series) -> pd.Series:
        out: list[list[int]] = [[] for _ in range(len(dims))]
        for dim in dims.unique():
            at = np.flatnonzero((dims == dim).to_numpy())
            cells = cells_of(_unit(vectors.iloc[at]), centres[int(dim)], threshold)
            for k, c in zip(at, cells, strict=True):
                out[k] = c.tolist()
        return pd.Series(out, dtype=object)

    return assign.asNondeterministic()


def _comparer(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows at home in block h against the rows present in block p."""
        h, p = rows["h"].iat[0], rows["p"].iat[0]
        unit = _unit(rows["vector"])
        asks = np.flatnonzero((rows["home"] & (rows["own"] == h)).to_numpy())
        seen = np.flatnonzero((rows["own"] == p).to_numpy())
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        root = np.arange(len(rows))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        links = np.zeros(len(rows), np.int64)
        for lo in range(0, len(asks), 256):
            part = asks[lo : lo + 256]
            near = (unit[part] @ unit[seen].T) >= threshold
            near &= node[part][:, None] != node[seen]
            links[part] = near @ copies[seen]
            for k, line in zip(part, near, strict=True):
                others = seen[line]
                if len(others):
                    # one step for all that already share a root
                    for o in np.unique(root[others]):
                        a, b = find(k), find(o)
                        if a != b:
                            root[max(a, b)] = min(a, b)
        top = np.array([find(k) for k in range(len(rows))], np.int64)
        out = pd.DataFrame({"node": node, "links": links, "root": node[top]})
        return out[(links > 0) | (top != np.arange(len(rows)))]

    return compare
