"""Grid lookups. A grid is a table of nodes: whole-number ix, iy (and it) plus fields.

Node (ix, iy) lies at (ix * spacing, iy * spacing). The corners of each lattice cell are packed
into one row first, so a point meets the grid in a single equality join on its cell.
A value is missing where any corner with weight is missing, as in plain linear interpolation.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.operators.skew import attach
from icegrid.session import by_group


def _pack_corners(
    grid: DataFrame, axes: list[str], fields: list[str], keys: list[str]
) -> DataFrame:
    """One row per cell (axes hold its lowest corner) with a column per field and corner."""
    corners = list(product((0, 1), repeat=len(axes)))
    code = [sum(b << i for i, b in enumerate(c)) for c in corners]
    moves = F.array(*[
        F.struct(*[(F.col(a) - b).alias(a) for a, b in zip(axes, c)], F.lit(n).alias("_n"))
        for c, n in zip(corners, code)
    ])
    rest = [F.col(c) for c in [*keys, *fields]]
    moved = grid.select(F.explode(moves).alias("_m"), *rest).select("_m.*", *[*keys, *fields])
    return moved.groupBy(*keys, *axes).agg(*[
        F.max(F.when(F.col("_n") == n, F.col(f).cast("double"))).alias(f"_{f}_{n}")
        for f in fields for n in code
    ])


def _blend(field: str, fracs: list[Column], corner: int = 0) -> Column:
    """Linear interpolation along the last axis of the values blended along the axes before.

    The upper side may be missing where it has no weight; the lower side always has some.
    """
    if not fracs:
        return F.col(f"_{field}_{corner}")
    *before, f = fracs
    low = _blend(field, before, corner)
    high = _blend(field, before, corner + (1 << len(before)))
    return low * (1 - f) + F.when(f == 0, 0.0).otherwise(high * f)


def _interp(
    points: DataFrame, grid: DataFrame, fields: dict[str, str], coords: dict[str, Column],
    keys: list[str],
) -> DataFrame:
    axes = list(coords)
    cells = {a: f"_cell_{a}" for a in axes}
    packed = _pack_corners(grid, axes, list(fields), keys)
    packed = packed.withColumnsRenamed(cells)
    cast = dict(grid.dtypes)
    rows = points.withColumns({cells[a]: F.floor(c).cast(cast[a]) for a, c in coords.items()})
    rows = rows.withColumns({f"_frac_{a}": c - F.col(cells[a]) for a, c in coords.items()})
    rows = attach(rows, packed, [*keys, *cells.values()])
    fracs = [F.col(f"_frac_{a}") for a in axes]
    out = rows.withColumns({name: _blend(f, fracs) for f, name in fields.items()})
    packed_cols = [c for c in packed.columns if c not in keys]
    return out.drop(*packed_cols, *[f"_frac_{a}" for a in axes])


def interp2(
    points: DataFrame, grid: DataFrame, fields: dict[str, str], spacing: float,
    keys: list[str] | None = None, x: str = "x", y: str = "y",
) -> DataFrame:
    """Bilinear values of grid fields at points; fields maps a grid field to its new name."""
    coords = {"ix": F.col(x) / spacing, "iy": F.col(y) / spacing}
    return _interp(points, grid, fields, coords, keys or [])


def interp3(
    points: DataFrame, grid: DataFrame, fields: dict[str, str], spacing: float,
    t_start: float, t_step: float, keys: list[str] | None = None, t: str = "time",
) -> DataFrame:
    """Trilinear values; epoch number it lies at t_start + it * t_step."""
    coords = {
        "ix": F.col("x") / spacing, "iy": F.col("y") / spacing,
        "it": (F.col(t) - t_start) / t_step,
    }
    return _interp(points, grid, fields, coords, keys or [])


def lattice(df: DataFrame, keys: list[str], pad: int = 0) -> DataFrame:
    """All nodes of the smallest box around the cells of each grid, with pad more all round."""
    box = df.groupBy(*keys).agg(
        (F.min("ix") - pad).alias("_x0"), (F.max("ix") + pad).alias("_x1"),
        (F.min("iy") - pad).alias("_y0"), (F.max("iy") + pad).alias("_y1"),
    )
    return _fill_box(box, keys)


def _fill_box(box: DataFrame, keys: list[str]) -> DataFrame:
    """All nodes of boxes _x0 ... _x1, _y0 ... _y1; their rows are made in parallel."""
    rows = box.withColumn("iy", F.explode(F.sequence("_y0", "_y1")))
    rows = by_group(rows, [*keys, "iy"])
    return rows.withColumn("ix", F.explode(F.sequence("_x0", "_x1"))).select(*keys, "ix", "iy")


def regrid(
    grid: DataFrame, fields: list[str], spacing: float, new_spacing: float,
    keys: list[str] | None = None,
) -> DataFrame:
    """The fields on the nodes of a new spacing within each grid's box; per epoch if in keys."""
    keys = keys or []
    box = grid.groupBy(*keys).agg(
        F.ceil(F.min("ix") * F.lit(spacing / new_spacing)).cast("int").alias("_x0"),
        F.floor(F.max("ix") * F.lit(spacing / new_spacing)).cast("int").alias("_x1"),
        F.ceil(F.min("iy") * F.lit(spacing / new_spacing)).cast("int").alias("_y0"),
        F.floor(F.max("iy") * F.lit(spacing / new_spacing)).cast("int").alias("_y1"),
    ).where("_x0 <= _x1 and _y0 <= _y1")
    nodes = _fill_box(box, keys).select(
        *keys, "ix", "iy",
        (F.col("ix") * new_spacing).alias("x"), (F.col("iy") * new_spacing).alias("y"),
    )
    return interp2(nodes, grid, {f: f for f in fields}, spacing, keys)


def nearest_cell(
    places: DataFrame, grid: DataFrame, fields: list[str], spacing: float,
    x: str = "x0", y: str = "y0",
) -> DataFrame:
    """Fields of the nearest node; a place halfway takes the lower node."""
    half = F.lit(0.5)
    rows = places.withColumns({
        "_ix": F.ceil(F.col(x) / spacing - half).cast("int"),
        "_iy": F.ceil(F.col(y) / spacing - half).cast("int"),
    })
    table = grid.select(F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), *fields)
    return attach(rows, table, ["_ix", "_iy"]).drop("_ix", "_iy")


def series_at(
    places: DataFrame, grid: DataFrame, fields: list[str], spacing: float
) -> DataFrame:
    """Bilinear time series at each place (x, y), over the epochs of the cells around it.

    An epoch is listed where all corners with weight have a value.
    """
    corner = F.array(*[
        F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i, j in product((0, 1), (0, 1))
    ])
    u, v = F.col("x") / spacing, F.col("y") / spacing
    need = places.withColumn("_c", F.explode(corner)).withColumns({
        "ix": (F.floor(u) + F.col("_c.di")).cast("int"),
        "iy": (F.floor(v) + F.col("_c.dj")).cast("int"),
    })
    fu, fv = u - F.floor(u), v - F.floor(v)
    w = F.when(F.col("_c.di") == 1, fu).otherwise(1 - fu) * F.when(
        F.col("_c.dj") == 1, fv
    ).otherwise(1 - fv)
    need = need.withColumn("_w", w).where("_w > 0").drop("_c")
    found = need.join(grid.select("ix", "iy", "it", *fields), ["ix", "iy"])
    total = found.groupBy(*places.columns, "it").agg(
        F.sum("_w").alias("_w"),
        *[F.sum(F.col("_w") * F.col(f)).alias(f) for f in fields],
        *[F.sum(F.when(F.col(f).isNotNull(), F.col("_w"))).alias(f"_w_{f}") for f in fields],
    )
    full = {f: F.when(F.col(f"_w_{f}") > 1 - 1e-9, F.col(f)) for f in fields}
    out = total.where("_w > 1 - 1e-9").withColumns(full)
    return out.select(*places.columns, "it", *fields)


def slice_epoch(grid: DataFrame, it: int) -> DataFrame:
    return grid.where(F.col("it") == it)


def crop_grid(
    grid: DataFrame, box: tuple[float, float, float, float], pad: float = 0.0,
    t_range: tuple[float, float] | None = None, t_step: float | None = None,
) -> DataFrame:
    """Nodes within a widened box; epochs within a range widened by 1.05 steps."""
    grid = grid.where(
        F.col("x").between(box[0] - pad, box[1] + pad)
        & F.col("y").between(box[2] - pad, box[3] + pad)
    )
    if t_range is not None:
        wide = 1.05 * t_step
        grid = grid.where(F.col("t").between(t_range[0] - wide, t_range[1] + wide))
    return grid
