"""Connected parts of a mask, and the epochs in which each part has data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icegrid.operators.skew import attach
from icegrid.session import cut_lineage


def _runs(cells: DataFrame) -> DataFrame:
    """Unbroken runs of cells along a row; a run is named by its row and first column."""
    line = Window.partitionBy("iy").orderBy("ix")
    gap = F.col("ix") - F.row_number().over(line)
    part = Window.partitionBy("iy", "_g")
    rows = cells.withColumn("_g", gap).withColumn("_x", F.min("ix").over(part))
    run = F.col("iy").cast("long") * (1 << 32) + F.col("_x")
    return rows.select("ix", "iy", run.alias("run"))


def connected_components(cells: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label (the smallest run name) of the face-connected part of each distinct cell ix, iy.

    Cells shrink to runs first. Then each round links every run to the smallest neighbour it
    knows and jumps two links at a time, so rounds grow with the logarithm of the longest
    path. Each round is checkpointed. Runs jobs.
    """
    runs = cut_lineage(_runs(cells.select("ix", "iy").distinct()))
    above = runs.select("ix", (F.col("iy") - 1).alias("iy"), F.col("run").alias("other"))
    links = runs.join(above, ["ix", "iy"]).select("run", "other").distinct()
    edges = links.select(F.col("run").alias("u"), F.col("other").alias("v"))
    label = runs.select("run").distinct().withColumn("label", F.col("run"))
    for _ in range(max_rounds):
        # edges join parts by their labels; within a part nothing is left to do
        edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        edges = cut_lineage(edges.where("u <> v").distinct())
        if edges.isEmpty():
            break
        hook = edges.groupBy("v").agg(F.min("u").alias("to"))
        hook = _flatten(hook)
        edges = _relabel(_relabel(edges, hook, "u"), hook, "v")
        label = cut_lineage(_relabel(label, hook, "label"))
    else:
        raise RuntimeError("connected_components needs more rounds")
    return attach(runs, label, ["run"]).select("ix", "iy", "label")


def _relabel(df: DataFrame, hook: DataFrame, column: str) -> DataFrame:
    out = attach(df, hook.withColumnRenamed("v", column), [column])
    return out.withColumn(column, F.coalesce("to", column)).drop("to")


def _flatten(hook: DataFrame) -> DataFrame:
    """Follow links to their ends. Links always go to smaller names, so there are no circles."""
    while True:
        hook = cut_lineage(hook)
        up = hook.select(F.col("v").alias("to"), F.col("to").alias("_next"))
        jumped = attach(hook, up, ["to"])
        if jumped.where("_next is not null").isEmpty():
            return hook
        hook = jumped.select("v", F.coalesce("_next", "to").alias("to"))


def component_spans(dz: DataFrame, labels: DataFrame) -> DataFrame:
    """First and last epoch in which any cell of each part has more than one point."""
    seen = dz.where("count > 1").join(labels, ["ix", "iy"])
    return seen.groupBy("label").agg(F.min("it").alias("_first"), F.max("it").alias("_last"))


def mask_by_component(dz: DataFrame) -> DataFrame:
    """dz is missing before the first and after the last sampled epoch of its part.

    Parts are made of the cells with area; a part never sampled is missing throughout, and
    cells in no part are left as they are.
    """
    labels = connected_components(dz.where("cell_area > 0"))
    spans = component_spans(dz, labels)
    out = attach(attach(dz, labels, ["ix", "iy"]), spans, ["label"])
    inside = F.col("it").between(F.col("_first"), F.col("_last"))
    value = F.when(F.col("label").isNull() | F.coalesce(inside, F.lit(False)), F.col("dz"))
    return out.withColumn("dz", value).drop("label", "_first", "_last")
