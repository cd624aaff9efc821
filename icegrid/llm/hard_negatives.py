"""Hard negatives by lists that the anchors of a cluster share.

Anchors in order of their k-means cluster are cut into blocks. For a block with centre c whose
members are within the angle t of it, no member's product with a vector v at the angle a from c
can be above |member| |v| cos(max(0, a - t)). A task sorts its vectors by that bound once for each
block; every member walks the list until the bound is below what it still needs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icegrid.llm.embedding_dedup import fit_centres
from icegrid.operators.skew import number_rows
from icegrid.session import cut_lineage, scratch_dir

SCALE = 256
# Anchors that the centres are fitted on, about, anchors of a block, and the most centres.
FIT_ANCHORS = 20_000
BLOCK = 256
CENTRES = 1024
# Bytes of anchors that the driver and each task hold at once, and of the vectors of one list.
GROUP_BYTES = 16 << 20
LIST_BYTES = 16 << 20
# Vectors of a list that are multiplied at once.
STEP = 2048

_LEAST, _LAST = -(1 << 62), (1 << 63) - 1
# Bounds are raised by this angle and share, so that rounding never hides a vector.
_SLACK = 1e-6


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; those beyond 55 bits are cut off there."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0**53:
        return a @ b.T
    whole = np.array([list(map(int, x)) for x in a], object).reshape(a.shape)
    other = np.array([list(map(int, x)) for x in b], object).reshape(b.shape)
    return np.clip(whole @ other.T, -(1 << 55), 1 << 55).astype(np.int64)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, and the lengths; rows of length 0 stay."""
    size = np.sqrt((x * x).sum(axis=1))
    return x / np.where(size > 0, size, 1)[:, None], size


@dataclass
class Block:
    """Anchors that share a list: places in the group, vectors, lengths, centre and angle."""

    lo: int
    rows: np.ndarray
    labels: np.ndarray
    ids: np.ndarray

    def __post_init__(self):
        direction, self.size = unit(self.rows)
        self.centre = unit(direction.sum(axis=0)[None])[0][0]
        cosine = np.where(self.size > 0, direction @ self.centre, 1)
        self.angle = float(np.arccos(np.clip(cosine, -1, 1)).max())

    def bounds(self, direction: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each vector, what its product with a member of length 1 cannot exceed."""
        away = np.arccos(np.clip(direction @ self.centre, -1, 1)) - self.angle - _SLACK
        return size * (np.cos(np.maximum(0, away)) + _SLACK)


class Best:
    """The k entries of highest score, then smallest id, of each line; equal ones count once."""

    def __init__(self, lines: int, k: int):
        self.k = k
        self.score = np.full((lines, k), _LEAST, np.int64)
        self.ident = np.full((lines, k), _LAST, np.int64)

    def least(self, lo: int, hi: int) -> np.ndarray:
        """The k-th score of each line."""
        return self.score[lo:hi, -1]

    def add(self, line: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(line):
            return
        lines = np.unique(line)
        row = np.concatenate([np.repeat(lines, self.k), line])
        s = np.concatenate([self.score[lines].ravel(), score])
        i = np.concatenate([self.ident[lines].ravel(), ident])
        order = np.lexsort((i, -s, row))
        row, s, i = row[order], s[order], i[order]
        new = np.append(True, (row[1:] != row[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1]))
        row, s, i = row[new], s[new], i[new]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < self.k
        self.score[lines], self.ident[lines] = _LEAST, _LAST
        self.score[row[top], rank[top]] = s[top]
        self.ident[row[top], rank[top]] = i[top]


class Nearest:
    """Of each anchor, the k first other rows of its label."""

    def __init__(self, blocks: list[Block], k: int):
        self.best = Best(sum(len(b.rows) for b in blocks), k)

    def needed(self, block: Block, members: np.ndarray) -> np.ndarray:
        return self.best.score[block.lo + members, -1]

    def take(self, block: Block, members: np.ndarray, score, labels, ids) -> None:
        fits = (score >= self.needed(block, members)[:, None])
        fits &= block.labels[members][:, None] == labels
        fits &= block.ids[members][:, None] != ids
        row, column = np.nonzero(fits)
        self.best.add(block.lo + members[row], score[row, column].astype(np.int64), ids[column])


class Below:
    """Of each anchor and target score, the k first rows of other labels whose score is between
    low and high hundredths of it."""

    def __init__(self, blocks: list[Block], targets: np.ndarray, known: np.ndarray, k: int,
                 low: int, high: int):
        self.width = targets.shape[1]
        self.best = Best(targets.size, k)
        self.low = np.where(known, -((-low * targets) // 100), _LAST)
        self.high = np.where(known, (high * targets) // 100, _LEAST)
        self.low[self.low > self.high] = _LAST

    def _least(self, block: Block, members: np.ndarray) -> np.ndarray:
        line = (block.lo + members)[:, None] * self.width + np.arange(self.width)
        return np.maximum(self.low[block.lo + members], self.best.score[line, -1])

    def needed(self, block: Block, members: np.ndarray) -> np.ndarray:
        return self._least(block, members).min(axis=1)

    def take(self, block: Block, members: np.ndarray, score, labels, ids) -> None:
        least, high = self._least(block, members), self.high[block.lo + members]
        fits = (score >= least.min(axis=1)[:, None]) & (score <= high.max(axis=1)[:, None])
        fits &= block.labels[members][:, None] != labels
        row, column = np.nonzero(fits)
        value = score[row, column].astype(np.int64)
        inside = (value[:, None] >= least[row]) & (value[:, None] <= high[row])
        at, target = np.nonzero(inside)
        line = (block.lo + members[row[at]]) * self.width + target
        self.best.add(line, value[at], ids[column[at]])


def walk(block: Block, rows: np.ndarray, labels: np.ndarray, ids: np.ndarray, goal,
         direction: np.ndarray, size: np.ndarray) -> int:
    """Let the members of a block walk one list; the products made."""
    bound = block.bounds(direction, size)
    order = np.argsort(-bound)
    members = np.arange(len(block.rows))
    made = 0
    for lo in range(0, len(order), STEP):
        # a bound equal to what is needed may still win by its id
        reach = bound[order[lo]] * block.size[members] * (1 + _SLACK) + _SLACK
        members = members[reach >= goal.needed(block, members)]
        if not len(members):
            break
        part = order[lo : lo + STEP]
        made += len(members) * len(part)
        goal.take(block, members, products(block.rows[members], rows[part]), labels[part], ids[part])
    return made


def _lists(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """ids, labels and vectors of length dim, up to LIST_BYTES of them at a time."""
    held, count = [], 0
    for batch in batches:
        sizes = pc.list_value_length(batch.column("q"))
        batch = batch.filter(pc.equal(sizes, dim))
        if batch.num_rows:
            flat = batch.column("q").flatten().to_numpy().astype(np.float64)
            held.append((batch.column("id").to_numpy(), batch.column("label").to_numpy(),
                         flat.reshape(batch.num_rows, dim)))
            count += batch.num_rows
        if count * 8 * max(1, dim) >= LIST_BYTES:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, count = [], 0
    if count:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _mine(batches: Iterator[pa.RecordBatch], dim: int, blocks: list[Block], goal
          ) -> Iterator[pa.RecordBatch]:
    """line, id and score of the best of one task."""
    for ids, labels, rows in _lists(batches, dim):
        direction, size = unit(rows)
        for block in blocks:
            walk(block, rows, labels, ids, goal, direction, size)
    line, rank = np.nonzero(goal.best.score > _LEAST)
    yield pa.RecordBatch.from_arrays(
        [pa.array(line, pa.int64()), pa.array(goal.best.ident[line, rank]),
         pa.array(goal.best.score[line, rank])], names=["line", "id", "score"])


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k first entries of each line over all tasks, with their rank; equal ones count once."""
    order = Window.partitionBy("line").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return found.distinct()


def _placed(anchors: DataFrame) -> DataFrame:
    """anchors with place: their number, from 0, in the order of length and cluster."""
    spark = anchors.sparkSession
    sizes = {r["dim"]: r["n"] for r in anchors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    centres = {}
    for dim, n in sizes.items():
        rows = anchors.where(F.col("dim") == dim)
        if n > FIT_ANCHORS:
            share = int(FIT_ANCHORS / n * (1 << 32))
            rows = rows.where(F.pmod(F.xxhash64("q", F.lit(5)), F.lit(1 << 32)) < share)
        if n > BLOCK and dim:
            sample = unit(np.array([r[0] for r in rows.select("q").collect()], np.float64))[0]
            centres[dim] = fit_centres(sample, min(CENTRES, math.ceil(n / BLOCK)))
    shared = spark.sparkContext.broadcast(centres)

    @F.arrow_udf("int")
    def cluster(vectors: pa.Array) -> pa.Array:
        out = [0] * len(vectors)
        for k, v in enumerate(vectors.to_pylist()):
            if len(v) in shared.value:
                out[k] = int((shared.value[len(v)] @ np.array(v, np.float64)).argmax())
        return pa.array(out, pa.int32())

    placed = anchors.withColumn("cluster", cluster("q"))
    return cut_lineage(number_rows(placed, ["dim", "cluster", "id", "label", "q"], "place")
                       .withColumn("place", F.col("place") - 1))


def _spans(placed: DataFrame) -> Iterator[tuple[int, int, int]]:
    """Length, first and last place of groups of about GROUP_BYTES of anchors."""
    ends = placed.groupBy("dim").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
    for r in ends.orderBy("dim").collect():
        rows = max(BLOCK, GROUP_BYTES // (8 * max(1, r["dim"])))
        for lo in range(r["lo"], r["hi"] + 1, rows):
            yield r["dim"], lo, min(lo + rows - 1, r["hi"])


def _group(placed: DataFrame, dim: int, lo: int, hi: int) -> tuple[list[Block], np.ndarray]:
    """The blocks and ids of one group of anchors."""
    got = placed.where(F.col("place").between(lo, hi)).select("place", "id", "label", "q").collect()
    got.sort(key=lambda r: r["place"])
    vectors = np.array([r["q"] for r in got], np.float64).reshape(len(got), dim)
    labels, ids = (np.array([r[c] for r in got], np.int64) for c in ("label", "id"))
    return [Block(b, vectors[b : b + BLOCK], labels[b : b + BLOCK], ids[b : b + BLOCK])
            for b in range(0, len(got), BLOCK)], ids


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: int = SCALE, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor and each of its positives, the hardest rows of other labels.

    Components become floor(scale * x); a score is the whole-number product with the anchor.
    An anchor's positives are the other rows of its label with the highest scores, its negatives
    for a positive the rows of other labels with the highest scores between low and high
    hundredths of the positive's; ties go to the smaller id. Returns anchor_id, positive_id, rank
    (from 1), negative_id, positive_score, negative_score.

    Rows without id, label or vector, or with a null or non-finite component, take no part.
    Labels and ids are whole numbers. Vectors of different lengths are not compared; empty ones
    score 0; scores beyond 55 bits are cut off there. Repeated rows count once; an id with several vectors is several rows, none of them
    an other row to the rest. An anchor without positive or a positive without negative gives no
    row. Columns other than the three are not read, but is_anchor may use any.

    Anchors are taken in groups of bounded bytes, which the driver and each task hold, and each
    group is two scans of the vectors: positives, then negatives. A task keeps only the first
    rows of each anchor, so what is shuffled does not depend on its number of vectors. All lists
    are walked until it is certain that nothing is missed. Runs jobs.
    """
    spark = vectors.sparkSession
    x = F.col(f"`{vector_col}`")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.coalesce(fine, F.lit(False)).alias("fine"),
    ).where("fine and id is not null and label is not null").drop("fine")
    anchors = rows.where("anchor").select("id", "label", "q", F.size("q").alias("dim")).distinct()
    rows = rows.drop("anchor")
    placed = _placed(cut_lineage(anchors))
    folder = scratch_dir(spark, "negatives")
    groups = list(_spans(placed))
    for dim, lo, hi in groups:
        blocks, ids = _group(placed, dim, lo, hi)
        shared = spark.sparkContext.broadcast((dim, blocks))

        def nearest(batches, shared=shared):
            dim, blocks = shared.value
            return _mine(batches, dim, blocks, Nearest(blocks, positives))

        found = _first(rows.mapInArrow(nearest, "line long, id long, score long"), positives)
        target = np.zeros((len(ids), positives), np.int64)
        name, known = np.zeros_like(target), np.zeros(target.shape, bool)
        for line, ident, score, rank in found.collect():
            target[line, rank - 1], name[line, rank - 1], known[line, rank - 1] = score, ident, True
        goal = spark.sparkContext.broadcast((target, known))

        def below(batches, shared=shared, goal=goal):
            dim, blocks = shared.value
            return _mine(batches, dim, blocks, Below(blocks, *goal.value, negatives, low, high))

        found = _first(rows.mapInArrow(below, "line long, id long, score long"), negatives)
        pairs = [(int(a * positives + j), int(ids[a]), int(name[a, j]), int(target[a, j]))
                 for a, j in zip(*np.nonzero(known), strict=True)]
        pairs = spark.createDataFrame(
            pairs, "line long, anchor_id long, positive_id long, positive_score long")
        part = pairs.join(found, "line").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        if len(groups) == 1:
            return part
        part.write.mode("append").parquet(folder)
        shared.destroy()
        goal.destroy()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    return spark.read.schema(schema).parquet(folder) if groups else spark.createDataFrame([], schema)
