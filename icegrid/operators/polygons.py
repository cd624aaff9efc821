"""Polygons as edge tables (poly_id, x1, y1, x2, y2) and their cells on a node lattice.

A cell is inside if its centre is (even-odd rule). Edges are cut into one crossing per row of
centres, crossings combine to at most one toggle per row and column, and the spans between
toggles are the cells: no cell is ever compared with every edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icegrid.operators.skew import attach


def polygon_edges(rings: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Edges of rings given as ordered vertices x, y; the last vertex joins the first.

    Vertex numbers must be 0, 1, 2, ... in each ring.
    """
    size = rings.groupBy(*keys).agg(F.count("*").alias("_n"))
    start = attach(rings, size, keys).withColumn(
        "_next", F.pmod(F.col(order) + 1, F.col("_n"))
    )
    end = rings.select(
        *keys, F.col(order).alias("_next"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    return start.join(end, [*keys, "_next"]).select(
        *keys, F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2"
    )


def ring_vertices(features: DataFrame, coordinates: str, keys: list[str]) -> DataFrame:
    """Vertices of rings read from JSON, as an array of [lon, lat] arrays, with their order."""
    rows = features.select(*keys, F.posexplode(coordinates).alias("seq", "_p"))
    return rows.select(
        *keys, "seq", F.element_at("_p", 1).alias("lon"), F.element_at("_p", 2).alias("lat")
    )


def _row_span(spacing: float) -> tuple[Column, Column]:
    """First and last row of centres that an edge crosses, lower end included, upper not."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    return F.ceil(low / spacing).cast("int"), (F.ceil(high / spacing) - 1).cast("int")


def rasterize(edges: DataFrame, spacing: float, keys: list[str]) -> DataFrame:
    """Distinct cells (keys, ix, iy) whose centre lies in the polygon."""
    first, last = _row_span(spacing)
    rows = edges.withColumns({"_a": first, "_b": last}).where("_a <= _b")
    rows = rows.withColumn("iy", F.explode(F.sequence("_a", "_b")))
    y = F.col("iy") * F.lit(float(spacing))
    x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (
        F.col("y2") - F.col("y1")
    )
    # a crossing toggles every cell whose centre lies beyond it
    toggles = rows.select(*keys, "iy", F.ceil(x / spacing).cast("int").alias("_from"))
    toggles = toggles.groupBy(*keys, "iy", "_from").agg(F.count("*").alias("_n"))
    toggles = toggles.where("_n % 2 = 1")
    line = Window.partitionBy(*keys, "iy").orderBy("_from")
    spans = toggles.withColumns({
        "_until": F.lead("_from").over(line) - 1, "_k": F.row_number().over(line)
    }).where("_k % 2 = 1")
    return spans.select(*keys, "iy", F.explode(F.sequence("_from", "_until")).alias("ix"))


def touched_cells(edges: DataFrame, spacing: float, keys: list[str]) -> DataFrame:
    """Distinct cells whose closed square any edge meets."""
    half = spacing / 2
    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("iy", F.explode(F.sequence(
        F.ceil((low_y - half) / spacing).cast("int"),
        F.floor((high_y + half) / spacing).cast("int"),
    )))
    # the part of the edge within the closed row, as a range of x
    bottom, top = F.col("iy") * spacing - half, F.col("iy") * spacing + half
    dy = F.col("y2") - F.col("y1")

    def x_at(y: Column) -> Column:
        y = F.least(F.greatest(y, low_y), high_y)
        return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / dy

    flat = dy == 0
    xa = F.when(flat, F.col("x1")).otherwise(x_at(bottom))
    xb = F.when(flat, F.col("x2")).otherwise(x_at(top))
    cells = F.sequence(
        F.ceil((F.least(xa, xb) - half) / spacing).cast("int"),
        F.floor((F.greatest(xa, xb) + half) / spacing).cast("int"),
    )
    return rows.select(*keys, "iy", F.explode(cells).alias("ix")).distinct()


def rasterize_touched(edges: DataFrame, spacing: float, keys: list[str]) -> DataFrame:
    """Distinct cells that the polygon covers in any part."""
    inside = rasterize(edges, spacing, keys).select(*keys, "iy", "ix")
    return inside.union(touched_cells(edges, spacing, keys)).distinct()


def polygon_mask(
    edges: DataFrame, cells: DataFrame, spacing: float, all_touched: bool = False
) -> DataFrame:
    """The cells with mask 1 in any of the polygons, else 0."""
    inside = (rasterize_touched if all_touched else rasterize)(edges, spacing, ["poly_id"])
    inside = inside.select("ix", "iy").distinct().withColumn("_in", F.lit(1))
    out = attach(cells, inside, ["ix", "iy"])
    return out.withColumn("mask", F.coalesce("_in", F.lit(0))).drop("_in")


def burn(
    mask: DataFrame, edges: DataFrame, spacing: float, field: str = "mask"
) -> DataFrame:
    """Write each polygon's burn_value into its cells, in burn_order; the last one stays."""
    burnt = rasterize(edges, spacing, ["poly_id", "burn_order", "burn_value"])
    last = burnt.groupBy("ix", "iy").agg(
        F.max_by("burn_value", F.struct("burn_order", "poly_id")).alias("_v")
    )
    out = attach(mask, last, ["ix", "iy"])
    return out.withColumn(field, F.coalesce("_v", field)).drop("_v")


def asof_before(bands: DataFrame, versions: DataFrame, t: str = "t") -> DataFrame:
    """For each band time the latest version strictly before it, else the first one.

    versions holds version_t. Only distinct epochs are ordered, year by year; what the years
    before hand on is one row per year.
    """
    times = bands.select(F.col(t).cast("double").alias("_t"), F.lit(0).alias("_kind")).distinct()
    marks = versions.select(F.col("version_t").cast("double"), F.lit(1).alias("_kind")).distinct()
    events = times.unionAll(marks).withColumn("_year", F.floor("_t"))
    mark = F.when(F.col("_kind") == 1, F.col("_t"))
    # at equal times the band comes first, so a version does not serve its own moment
    line = Window.partitionBy("_year").orderBy("_t", "_kind")
    seen = events.withColumn("_here", F.last(mark, ignorenulls=True).over(line))
    yearly = events.groupBy("_year").agg(F.max(mark).alias("_last"), F.min(mark).alias("_first"))
    past = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_year").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    yearly = yearly.select(
        "_year", F.last("_last", ignorenulls=True).over(past).alias("_carry"),
        F.min("_first").over(whole).alias("_first"),
    )
    found = attach(seen.where("_kind = 0"), yearly, ["_year"]).select(
        F.col("_t").alias(t), F.coalesce("_here", "_carry", "_first").alias("version_t")
    )
    return attach(bands, found, [t])
