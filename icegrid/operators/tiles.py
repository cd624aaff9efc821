"""Overlapping square tiles on a regular lattice of centres."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.functions import bin_centre, npmod, parse_tile_name
from icegrid.operators.interp import interp2
from icegrid.operators.raster import dilate, downsample, pad_canvas
from icegrid.operators.skew import keep

# Moves, in half tiles, from a centre to the tiles of each processing step.
STEP_MOVES = {
    "centers": [(0, 0)],
    "prelim": [(0, 0)],
    "matched": [(0, 0)],
    "edges": [(-1, 0), (0, -1), (0, 1), (1, 0)],
    "corners": [(-1, -1), (1, -1), (-1, 1), (1, 1)],
}


def _centres(v: Column, width: float, spacing: float) -> Column:
    low, high = F.ceil((v - width / 2) / spacing), F.floor((v + width / 2) / spacing)
    span = F.sequence(low.cast("int"), high.cast("int"))
    return F.when(low <= high, span)


def assign_tiles(df: DataFrame, width: float = 6e4, spacing: float = 4e4) -> DataFrame:
    """One row per point and tile whose closed box holds it; adds the centre x0, y0.

    Where boxes leave gaps (width below spacing), points in a gap go to no tile.
    """
    df = df.withColumn("_i", F.explode(_centres(F.col("x"), width, spacing)))
    df = df.withColumn("_j", F.explode(_centres(F.col("y"), width, spacing)))
    return df.withColumns({
        "x0": F.col("_i") * F.lit(float(spacing)), "y0": F.col("_j") * F.lit(float(spacing))
    }).drop("_i", "_j")


def nearest_tile_dedupe(
    df: DataFrame, bin_m: float = 1e4, order: list[str] | None = None,
    within: list[str] | None = None,
) -> DataFrame:
    """Of points held by several tiles keep, bin by bin, those of the nearest tile.

    Near means the tile centre to the bin centre. Among equally near tiles the first by the
    order columns wins, then by x0, y0. Rows that differ in the columns within are kept apart.
    """
    within = within or []
    df = df.withColumns({
        "_bx": bin_centre(F.col("x"), bin_m), "_by": bin_centre(F.col("y"), bin_m)
    })
    dx, dy = F.col("_bx") - F.col("x0"), F.col("_by") - F.col("y0")
    rank = [F.min(c).alias(c) for c in (order or [])]
    seen = df.groupBy(*within, "_bx", "_by", "x0", "y0").agg(F.min(dx * dx + dy * dy).alias("_d"), *rank)
    key = F.struct("_d", *(order or []), "x0", "y0")
    owner = seen.groupBy(*within, "_bx", "_by").agg(
        F.min_by(F.struct("x0", "y0"), key).alias("_o"))
    owner = owner.select(*within, "_bx", "_by", "_o.*")
    return keep(df, owner, [*within, "_bx", "_by", "x0", "y0"]).drop("_bx", "_by")


def neighbour_tiles(tiles: DataFrame, step: float, single: bool = False) -> DataFrame:
    """Each tile with the tiles of the table up to one step away, itself included."""
    moves = [(0, 0)] if single else list(product((-1, 0, 1), (-1, 0, 1)))
    near = tiles.select(
        F.col("x0"), F.col("y0"), F.explode(_moves(moves)).alias("_m")
    ).select(
        "x0", "y0", (F.col("x0") + F.col("_m.i") * step).alias("nx0"),
        (F.col("y0") + F.col("_m.j") * step).alias("ny0"),
    )
    there = tiles.select(F.col("x0").alias("nx0"), F.col("y0").alias("ny0")).distinct()
    return keep(near, there, ["nx0", "ny0"]).select("x0", "y0", "nx0", "ny0")


def _moves(moves: list[tuple[int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in moves])


def step_tiles(tiles: DataFrame, step: str, spacing: float) -> DataFrame:
    """Distinct tiles of a processing step around the centres."""
    moved = tiles.select("x0", "y0", F.explode(_moves(STEP_MOVES[step])).alias("_m"))
    half = spacing / 2
    return moved.select(
        (F.col("x0") + F.col("_m.i") * half).alias("x0"),
        (F.col("y0") + F.col("_m.j") * half).alias("y0"),
    ).distinct()


def tiles_from_names(names: DataFrame, name: str = "name") -> DataFrame:
    """Distinct centres in file names."""
    x, y = parse_tile_name(F.col(name))
    return names.select(x.alias("x0"), y.alias("y0")).where("x0 is not null").distinct()


def tiles_from_commands(lines: DataFrame, line: str = "line") -> DataFrame:
    """Distinct centres given by the --xy0 option of command lines."""
    pattern = r"--xy0\s+(\S+)\s+(\S+)"  # fixed value: the option format
    x, y = (F.regexp_extract(line, pattern, i).try_cast("double") for i in (1, 2))
    return lines.select(x.alias("x0"), y.alias("y0")).where("x0 is not null").distinct()


def tile_centres(
    mask: DataFrame, cell: float, spacing: float, pad: int = 200, field: str = "mask"
) -> DataFrame:
    """Lattice tiles near the mask: spread it 1.5 tiles, keep centres that fall on it."""
    n = int(1.5 * spacing / cell) + 1
    wide = dilate(pad_canvas(mask, pad, field), n, n, field)
    return _centres_on(wide, cell, spacing, field)


def tile_centres_coarse(
    mask: DataFrame, cell: float, spacing: float, pad: int = 200, field: str = "mask",
    offset: int = 2,
) -> DataFrame:
    """As tile_centres, on a mask spread by five cells and thinned to every fourth."""
    mask = downsample(dilate(pad_canvas(mask, pad, field), 5, 5, field), offset, 4)
    n = int(1.5 * spacing / (4 * cell)) + 1
    return _centres_on(dilate(mask, n, n, field), 4 * cell, spacing, field, offset * cell)


def _centres_on(
    mask: DataFrame, cell: float, spacing: float, field: str, shift: float = 0.0
) -> DataFrame:
    """Lattice centres whose interpolated mask is one; node 0 of the mask lies at shift."""
    half = spacing / 2
    at = mask.select(
        (F.rint((F.col("ix") * cell + shift) / half) * half).alias("x0"),
        (F.rint((F.col("iy") * cell + shift) / half) * half).alias("y0"),
    ).distinct()
    at = at.where((npmod(F.col("x0"), spacing) == 0) & (npmod(F.col("y0"), spacing) == 0))
    at = at.withColumns({"_x": F.col("x0") - shift, "_y": F.col("y0") - shift})
    at = interp2(at, mask, {field: "_m"}, cell, x="_x", y="_y")
    return at.where(F.abs(F.col("_m") - 1) < 0.1).select("x0", "y0")


def tiles_of_coarse_mask(mask: DataFrame, cell: float, field: str = "mask") -> DataFrame:
    """Centres of the set cells of a mask made on the tile lattice itself."""
    return mask.where(F.col(field) == 1).select(
        (F.col("ix") * F.lit(float(cell))).alias("x0"), (F.col("iy") * F.lit(float(cell))).alias("y0")
    )
