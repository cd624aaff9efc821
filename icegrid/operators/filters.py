"""Point filters, edits and tile gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icegrid.functions import parent_tile
from icegrid.operators.interp import interp2
from icegrid.operators.skew import group_median, keep, leave, with_group_median

# Known bad (track, cycle) pairs; the second counts only where the mean
# position of the tile's points lies within near_dist of the named place on both axes.
EDIT_LIST = [(741, 7, None, None, None), (1092, 1, 480000.0, -1360000.0, 1e5)]
EDIT_SCHEMA = "rgt int, cycle int, near_x double, near_y double, near_dist double"

Box = tuple[float, float, float, float]  # xmin, xmax, ymin, ymax


def in_box(df: DataFrame, box: Box) -> DataFrame:
    return df.where(F.col("x").between(box[0], box[1]) & F.col("y").between(box[2], box[3]))


def below_sigma(df: DataFrame, tol: float) -> DataFrame:
    return df.where(F.col("sigma") < tol)


def above_geoid(df: DataFrame, tol: float) -> DataFrame:
    return df.where(F.col("z") - F.col("geoid_h") > tol)


def edit_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDIT_LIST, EDIT_SCHEMA)


def apply_edit_list(df: DataFrame, edits: DataFrame, tile: list[str]) -> DataFrame:
    """Drop listed (track, cycle) pairs; a placed rule drops them only in tiles near its place.

    A tile's place is the mean of all its points, those to be dropped included.
    """
    pair = ["rgt", "cycle"]
    placed = edits.where("near_dist is not null")
    means = df.groupBy(*tile).agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my"))
    off = F.greatest(F.abs(F.col("_mx") - F.col("near_x")), F.abs(F.col("_my") - F.col("near_y")))
    # few points carry a listed pair, so only their tiles are measured against the place
    hits = df.select(*tile, *pair).join(placed, pair).distinct()
    local = hits.join(means, tile).where(off < F.col("near_dist")).select(*tile, *pair)
    df = leave(df, edits.where("near_dist is null").select(*pair), pair)
    return leave(df, local, [*tile, *pair])


def subtract_reference(
    df: DataFrame, dem: DataFrame, spacing: float, tol: float, tile: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Heights above a reference DEM, within tol of it, and per tile the median DEM error.

    dem holds ix, iy, h, h_sigma; the median is taken before points are dropped.
    """
    ref = interp2(df, dem, {"h": "z_ref", "h_sigma": "sigma_zref"}, spacing)
    spread = group_median(ref, tile, F.col("sigma_zref"), "sigma_ref_median")
    ref = ref.withColumn("z", F.col("z") - F.col("z_ref"))
    return ref.where(F.abs(F.col("z")) < tol), spread


def dem_block_edit(
    df: DataFrame, width: float, tol: float, tile: list[str], dem: str = "dem_h",
    block: float | None = None,
) -> DataFrame:
    """Clear three_sigma_edit where a height strays from its block's median offset to the DEM.

    Blocks are an eighth of the tile and half-open. Needs the tile centre x0, y0.
    """
    block = block or width / 8
    r = F.col("z") - F.col(dem)
    cells = df.withColumns({
        "_bi": F.floor((F.col("x") - (F.col("x0") - width / 2)) / block).cast("int"),
        "_bj": F.floor((F.col("y") - (F.col("y0") - width / 2)) / block).cast("int"),
        "_r": r,
    })
    keys = list(dict.fromkeys([*tile, "_bi", "_bj"]))
    cells = with_group_median(cells, keys, F.col("_r"), "_med")
    near = F.coalesce(F.abs(F.col("_r") - F.col("_med")) < tol, F.lit(False))
    flag = F.col("three_sigma_edit") & near if "three_sigma_edit" in df.columns else near
    return cells.withColumn("three_sigma_edit", flag).drop(
        "_bi", "_bj", "_r", "_med"
    )


def editable(df: DataFrame, width: float) -> DataFrame:
    """Points near the tile centre may be edited; points from neighbours may not."""
    near = (F.abs(F.col("x") - F.col("x0")) <= width / 2) & (
        F.abs(F.col("y") - F.col("y0")) <= width / 2
    )
    return df.withColumn("editable", near)


def restart_edit(df: DataFrame) -> DataFrame:
    if "three_sigma_edit" not in df.columns:
        return df
    return df.withColumn("three_sigma_edit", F.lit(True))


def sufficient_tiles(
    df: DataFrame, tile: list[str], width: float, edge_pad: float | None = None,
    min_points: int = 10, min_span: float = 80.0 / 365.0, min_inner: int = 50,
) -> DataFrame:
    """Tiles with enough points, over enough time, and enough of them off the edge."""
    off = F.greatest(F.abs(F.col("x") - F.col("x0")), F.abs(F.col("y") - F.col("y0")))
    inner = F.lit(True) if edge_pad is None else off < width / 2 - edge_pad
    stats = df.groupBy(*tile).agg(
        F.count("*").alias("n"),
        (F.max("time") - F.min("time")).alias("span"),
        F.count(F.when(inner, 1)).alias("n_inner"),
    )
    keep = (F.col("n") >= min_points) & (F.col("span") >= min_span)
    if edge_pad is not None:
        keep = keep & (F.col("n_inner") >= min_inner)
    return stats.where(keep)


def gate_tiles(df: DataFrame, tile: list[str], width: float, **kw) -> DataFrame:
    return keep(df, sufficient_tiles(df, tile, width, **kw), tile)


def select_tiles(
    tiles: DataFrame,
    box: Box | None = None,
    min_r: float | None = None,
    max_r: float | None = None,
    min_xy: float | None = None,
    max_xy: float | None = None,
) -> DataFrame:
    """Tiles by place: the box is closed in x and open in y; limits on radius are open."""
    x, y = F.col("x0"), F.col("y0")
    r, far = F.sqrt(x * x + y * y), F.greatest(F.abs(x), F.abs(y))
    if box is not None:
        tiles = tiles.where(x.between(box[0], box[1]) & (y > box[2]) & (y < box[3]))
    if min_r is not None:
        tiles = tiles.where(r > min_r)
    if max_r is not None:
        tiles = tiles.where(r < max_r)
    if min_xy is not None:
        tiles = tiles.where(far >= min_xy)
    if max_xy is not None:
        tiles = tiles.where(far <= max_xy)
    return tiles


def pending_tiles(
    tiles: DataFrame,
    done: DataFrame | None = None,
    listed: DataFrame | None = None,
    required: DataFrame | None = None,
) -> DataFrame:
    """Tiles on the list that have their earlier step and are not done yet."""
    keys = ["x0", "y0"]
    if listed is not None:
        tiles = keep(tiles, listed, keys)
    if required is not None:
        tiles = keep(tiles, required, keys)
    if done is not None:
        tiles = leave(tiles, done, keys)
    return tiles


def good_surface(df: DataFrame, mask: DataFrame, spacing: float) -> DataFrame:
    """Points on the mask with a good surface fit and a usable height and error."""
    df = interp2(df, mask, {"mask": "_mask"}, spacing)
    keep = (F.col("_mask") > 0.5) & (F.col("fit_quality") < 1)
    usable = F.col("z").isNotNull() & (F.col("sigma") > 0)
    return df.where(keep & usable).drop("_mask")


def cut_pole_hole(df: DataFrame, lat, fields: list[str], south_of: float = -88.0) -> DataFrame:
    """Zero the mask fields of cells beyond the latitude the satellite sees."""
    return df.withColumns(
        {f: F.when(lat < south_of, F.lit(0)).otherwise(F.col(f)) for f in fields}
    )


def parent_tiles(tiles: DataFrame, width: float = 2e5) -> DataFrame:
    """Distinct larger tiles that hold the tile centres."""
    return tiles.select(
        parent_tile(F.col("x0"), width).alias("x0"), parent_tile(F.col("y0"), width).alias("y0")
    ).distinct()
