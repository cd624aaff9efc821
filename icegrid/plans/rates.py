"""Height-change rates straight from points, without a fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icegrid.operators.aggregate import block_average, cell_means
from icegrid.operators.filters import dem_block_edit
from icegrid.operators.ordered import lagged_rate
from icegrid.operators.tiles import assign_tiles, nearest_tile_dedupe


def regional_rate(
    points: DataFrame, dem_tol: float, cell: float = 1e4, scale: float = 4e4,
    width: float = 6e4, spacing: float = 4e4, lag: int = 4, dt: float = 0.25,
) -> DataFrame:
    """Count-weighted rate over one lag, per block and epoch.

    Points are edited against the DEM in their tiles and averaged to cells; each cell keeps the
    values of its nearest tile, which give the rates.
    """
    edited = dem_block_edit(assign_tiles(points, width, spacing), width, dem_tol, ["x0", "y0"])
    used = edited.where("three_sigma_edit")
    cells = cell_means(used, cell, F.col("cycle"), keys=["x0", "y0"]).withColumns({
        "x": (F.col("ix") + 0.5) * cell, "y": (F.col("iy") + 0.5) * cell,
        "t": F.col("it") * F.lit(dt), "n": F.col("count").cast("double"),
    })
    # cells are the bins by which overlaps are resolved, so this needs no points any more
    cells = nearest_tile_dedupe(cells, cell)
    rates = lagged_rate(cells, (lag,), dt, field="z", carry=["n"])
    return block_average(rates, scale, cell, ["dzdt"], area="n")
