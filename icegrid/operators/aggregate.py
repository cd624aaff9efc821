"""Gridding aggregates, tile statistics and reports."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.functions import parse_granule_name, polar_latlon
from icegrid.operators.interp import lattice
from icegrid.operators.skew import attach, group_quantiles, number_rows

# Tolerances and error classes of the report against a reference DEM.
REPORT_TOLS = (100, 50, 25, 0)
SIGMA_CLASSES = (0, 1, 2, 4, 8, 16, 32, 64)
TILE_SPACING = 40000.0


def cell_means(
    df: DataFrame, spacing: float, epoch: Column, fields: tuple[str, ...] = ("z",),
    keys: list[str] | None = None,
) -> DataFrame:
    """Error-weighted means of the fields per cell and epoch, with the count of points."""
    keys = keys or []
    w = 1 / (F.col("sigma") * F.col("sigma"))
    cells = df.select(
        *keys, F.floor(F.col("x") / spacing).cast("int").alias("ix"),
        F.floor(F.col("y") / spacing).cast("int").alias("iy"),
        epoch.alias("it"), w.alias("_w"), *fields,
    )
    return cells.groupBy(*keys, "ix", "iy", "it").agg(
        *[(F.sum(F.col("_w") * F.col(f)) / F.sum("_w")).alias(f) for f in fields],
        F.count("*").alias("count"),
    )


def cell_misfit(
    points: DataFrame, spacing: float, residual: str = "r", keys: list[str] | None = None
) -> DataFrame:
    """Weighted point count, misfit RMS and error-scaled misfit RMS of the grid nodes.

    A point adds to the four nodes around it with its bilinear weights.
    """
    u, v = F.col("x") / spacing, F.col("y") / spacing
    fu, fv = u - F.floor(u), v - F.floor(v)
    corners = F.array(*[
        F.struct(
            (F.floor(u) + i).cast("int").alias("ix"), (F.floor(v) + j).cast("int").alias("iy"),
            ((fu if i else 1 - fu) * (fv if j else 1 - fv)).alias("w"),
        )
        for i, j in product((0, 1), (0, 1))
    ])
    r = F.col(residual)
    s = r / F.col("sigma")
    rows = points.select(
        *(keys or []), F.explode(corners).alias("_c"), (r * r).alias("_r2"), (s * s).alias("_s2")
    ).where("_c.w > 0").select(*(keys or []), "_c.*", "_r2", "_s2")
    total = F.sum("w")
    return rows.groupBy(*(keys or []), "ix", "iy").agg(
        total.alias("count"),
        F.sqrt(F.sum(F.col("w") * F.col("_r2")) / total).alias("misfit_rms"),
        F.sqrt(F.sum(F.col("w") * F.col("_s2")) / total).alias("misfit_scaled_rms"),
    )


def block_average(
    dz: DataFrame, scales: float | tuple[float, ...], spacing: float, fields: list[str],
    area: str = "cell_area", keys: list[str] | None = None,
) -> DataFrame:
    """Area-weighted means over square blocks, per epoch or lag; the area is the block's sum.

    With several scales the rows meet all of them in one pass and get a column scale_m.
    """
    keys = keys or ["it"]
    many = isinstance(scales, tuple)
    steps = F.array(*[F.lit(float(s)) for s in (scales if many else (scales,))])
    rows = dz.withColumn("_s", F.explode(steps))
    per = F.col("_s") / spacing
    rows = rows.withColumns({
        "_bx": F.floor(F.col("ix") / per).cast("int"), "_by": F.floor(F.col("iy") / per).cast("int"),
    })
    a = F.col(area)

    def mean(f: str) -> Column:
        used = F.when(F.col(f).isNotNull(), a)
        return F.try_divide(F.sum(a * F.col(f)), F.sum(used)).alias(f)

    out = rows.groupBy("_s", "_bx", "_by", *keys).agg(*[mean(f) for f in fields], F.sum(a).alias(area))
    scale = [F.col("_s").cast("int").alias("scale_m")] if many else []
    return out.select(
        *scale, F.col("_bx").alias("ix"), F.col("_by").alias("iy"), *keys, *fields, area
    )


def tile_stats(
    data: DataFrame, bias: DataFrame, rms: DataFrame, expected: DataFrame, tile: list[str]
) -> DataFrame:
    """Per tile: used points, data and bias RMS, bias count, constraint RMS and settings."""
    n = data.groupBy(*tile).agg(F.sum(F.col("three_sigma_edit").cast("int")).alias("N_data"))
    q = F.col("val") / F.col("expected")
    b = bias.groupBy(*tile).agg(
        F.sqrt(F.avg(q * q)).alias("RMS_bias"), F.count("*").alias("N_bias")
    )
    r = rms.select(
        *tile, F.col("data").alias("RMS_data"), F.col("grad2_z0").alias("RMS_d2z0dx2"),
        F.col("d2z_dt2").alias("RMS_d2zdt2"), F.col("grad2_dzdt").alias("RMS_d2zdx2dt"),
    )
    e = expected.select(
        *tile, F.col("d2z0_dx2").alias("sigma_xx0"), F.col("d2z_dt2").alias("sigma_tt"),
        F.col("d3z_dx2dt").alias("sigma_xxt"),
    )
    return n.join(b, tile, "left").join(r, tile, "left").join(e, tile, "left")


def tile_grid(stats: DataFrame, fields: list[str], spacing: float = TILE_SPACING) -> DataFrame:
    """Tile statistics on the full lattice of tiles; zero, NaN and absent values are missing."""
    cells = stats.withColumns({
        "ix": F.floor(F.col("x0") / spacing).cast("int"),
        "iy": F.floor(F.col("y0") / spacing).cast("int"),
    })
    corner = stats.agg(
        (F.min("x0") - F.floor(F.min("x0") / spacing) * spacing).alias("_ox"),
        (F.min("y0") - F.floor(F.min("y0") / spacing) * spacing).alias("_oy"),
    )
    full = attach(lattice(cells, []), cells.select("ix", "iy", *fields), ["ix", "iy"])

    def clean(f: str) -> Column:
        v = F.col(f)
        return F.when((v != 0) & ~F.isnan(v.cast("double")), v).alias(f)

    x = F.col("ix") * spacing + corner.select("_ox").scalar()
    y = F.col("iy") * spacing + corner.select("_oy").scalar()
    return full.select(x.alias("x"), y.alias("y"), *[clean(f) for f in fields])


def dem_report(points: DataFrame, tile: list[str], dem: str = "dem") -> DataFrame:
    """Per tile: how far points lie off a DEM, as given and as edited, in one pass.

    Edited counts also need an error. severity is the largest tolerance any edited point
    exceeds. Deviations are population values.
    """
    r = F.col("z") - F.col(dem)
    kept = F.col("three_sigma_edit")
    edited = kept & F.col("sigma").isNotNull()
    off, s = F.abs(r), F.col("sigma")

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    cols = []
    for t in REPORT_TOLS:
        cols += [
            n(edited & (off > t)).alias(f"n_{t}"), n(off > t).alias(f"n_raw_{t}"),
            F.sqrt(F.avg(F.when(edited & (off > t), s * s))).alias(f"rss_sigma_{t}"),
        ]
    for c in SIGMA_CLASSES:
        cols += [n(edited & (s > c)).alias(f"n_sigma_{c}"), n(s > c).alias(f"n_sigma_raw_{c}")]
    cols.append(F.stddev_pop(F.when(kept, r)).alias("std_dem"))
    if "z_est" in points.columns:
        cols.append(F.stddev_pop(F.when(kept, F.col("z") - F.col("z_est"))).alias("std_fit"))
    out = points.groupBy(*tile).agg(*cols)
    severity = F.lit(None).cast("int")
    for t in sorted(REPORT_TOLS):
        severity = F.when(F.col(f"n_{t}") > 0, t).otherwise(severity)
    return out.withColumn("severity", severity)


def field_sizes(tiles: DataFrame, tables: dict[str, DataFrame], tile: list[str]) -> DataFrame:
    """Per tile and field the number of rows, columns and epochs; NULL where it is missing."""
    out = tiles.select(*tile).distinct()
    for field, df in tables.items():
        axes = {"ny": "iy", "nx": "ix", "nt": "it"}
        sizes = df.where(F.col(field).isNotNull()).groupBy(*tile).agg(*[
            F.count_distinct(axis).alias(f"{field}_{name}") for name, axis in axes.items()
        ])
        out = out.join(sizes, tile, "left")
    return out


def lineage_files(meta: DataFrame, files: str = "input_files") -> DataFrame:
    """Distinct input files of all tiles, from their comma-separated lists."""
    text = F.regexp_replace(F.regexp_replace(files, "^b(?=')", ""), "'", "")
    names = meta.select(F.explode(F.split(text, ",")).alias("file"))
    return names.where("file <> ''").distinct()


def lineage(meta: DataFrame, granules: DataFrame) -> DataFrame:
    """One row per input file: attributes of its name and of the file itself.

    The end track is the file's own for crossovers, else the track of the name.
    """
    files = lineage_files(meta)
    named = files.select("file", *[c.alias(k) for k, c in parse_granule_name(F.col("file")).items()])
    rows = named.join(granules.withColumnsRenamed({
        "start_rgt": "_rgt0", "end_rgt": "_rgt1", "file": "_file"
    }), F.col("file") == F.col("_file"), "left").drop("_file")
    start = F.coalesce(F.col("start_rgt").cast("int"), F.col("_rgt0"))
    end = F.when(F.col("start_rgt").isNull(), F.col("_rgt1")).otherwise(start)
    return rows.withColumns({
        "start_rgt": start, "end_rgt": end, "end_region": F.col("start_region"),
    }).drop("_rgt0", "_rgt1").distinct()


def lineage_positions(rows: DataFrame) -> DataFrame:
    """The lineage with the position of each file, from 1 in name order: column c, by position,
    is the list of attribute c of the product. Runs a job."""
    return number_rows(rows, ["file"], "position")


def coverage(rows: DataFrame, region: str | None = None) -> DataFrame:
    """First and last data time. With a region code, the coded start of that region is used:
    2019-01-01 plus 3 and 2 seconds per unit of its two character codes."""
    start = F.min("start_delta_time")
    if region is not None:
        start = F.lit(365.0 * 86400 + 3 * ord(region[0]) + 2 * ord(region[1]))
    return rows.agg(start.alias("start"), F.max("end_delta_time").alias("end")).withColumn(
        "duration", F.col("end") - F.col("start")
    )


def geo_bounds(grid: DataFrame, hemi: int) -> DataFrame:
    """Geographic extent of a map grid, from a three by three lattice over its box."""
    box = grid.agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    at = F.array(*[
        F.struct(
            (F.col("x0") + (F.col("x1") - F.col("x0")) / 2 * i).alias("x"),
            (F.col("y0") + (F.col("y1") - F.col("y0")) / 2 * j).alias("y"),
        )
        for i in range(3) for j in range(3)
    ])
    pts = box.select(F.explode(at).alias("_p")).select("_p.x", "_p.y")
    lat, lon = polar_latlon(F.col("x"), F.col("y"), hemi)
    ext = pts.select(lat.alias("lat"), lon.alias("lon")).agg(
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
    )
    whole = (F.col("lon_min") == -180) | (F.col("lon_max") == 180)
    return ext.withColumns({
        "lon_min": F.when(whole, -180.0).otherwise(F.col("lon_min")),
        "lon_max": F.when(whole, 180.0).otherwise(F.col("lon_max")),
    })


def polygon_bounds(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Extent of region polygons; longitudes near a pole do not count."""
    lon = F.when(F.abs(F.col("lat")) <= 88.0, F.col("lon"))
    return vertices.groupBy(*keys).agg(
        F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
    )


def time_statistics(grid: DataFrame, field: str) -> DataFrame:
    """Mean and population deviation over time of every cell."""
    return grid.groupBy("ix", "iy").agg(
        F.avg(field).alias("mean"), F.stddev_pop(field).alias("std")
    )


def browse_limits(cells: DataFrame, fields: dict[str, tuple[float, float]]) -> DataFrame:
    """Colour limits: low and high percentile of each field, and the symmetric limit."""
    out = None
    for f, (low, high) in fields.items():
        q = group_quantiles(
            cells.withColumn("field", F.lit(f)), ["field"], F.col(f), {"low": low, "high": high}
        )
        out = q if out is None else out.unionByName(q)
    return out.withColumn("limit", F.greatest(F.abs(F.col("low")), F.abs(F.col("high"))))


def robust_spread(
    df: DataFrame, keys: list[str], value: Column, name: str = "spread", **kw
) -> DataFrame:
    """Half the distance between the 16th and 84th percentile."""
    q = group_quantiles(df, keys, value, {"_lo": 0.16, "_hi": 0.84}, **kw)
    return q.select(*keys, ((F.col("_hi") - F.col("_lo")) / 2).alias(name))


def data_span(df: DataFrame, tile: list[str]) -> DataFrame:
    """First and last data time, ranges of position and height, and count per tile."""
    cols = [F.min("delta_time").alias("first_delta_time"), F.max("delta_time").alias("last_delta_time")]
    for c in ("x", "y", "z"):
        cols += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(*tile).agg(*cols, F.count("*").alias("n"))


def reconcile_ids(sensors: DataFrame) -> DataFrame:
    """New sensor numbers for (file_order, sensor, num): 1, 2, ... by first file and number.

    Runs a job.
    """
    first = sensors.groupBy("sensor").agg(F.min(F.struct("file_order", "num")).alias("_first"))
    new = number_rows(first, ["_first", "sensor"], "new_num")
    new = new.select("sensor", F.col("new_num").cast("int").alias("new_num"))
    return attach(sensors, new, ["sensor"])


def remap_ids(data: DataFrame, mapping: DataFrame) -> DataFrame:
    """Data with reconciled sensor numbers; -1 for a number its file does not name."""
    table = mapping.select("file_order", F.col("num").alias("sensor_num"), "new_num")
    out = attach(data, table, ["file_order", "sensor_num"])
    return out.withColumn("new_num", F.coalesce("new_num", F.lit(-1)))
