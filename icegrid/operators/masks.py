"""Mask making and mask-driven corrections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.functions import firn_height, geoid_mean_tide, recorrect
from icegrid.operators.interp import interp2, interp3, regrid
from icegrid.operators.ordered import band_extension
from icegrid.operators.polygons import asof_before, rasterize
from icegrid.operators.raster import dilate, fill_gaps, open_mask
from icegrid.operators.skew import attach

WATER_DENSITY = 1.0
# Mask bands after this year are used, and the epoch that is left out; the
# "add" patch holds before its year, the "remove" patch after its year.
BANDS_AFTER, BAND_DROPPED = 2018.0, 2021.2
PATCH_ADD_BEFORE, PATCH_REMOVE_AFTER = 2023.0, 2021.5


def apply_tides(
    points: DataFrame, mask: DataFrame, spacing: float, scale: DataFrame | None = None,
    scale_spacing: float | None = None,
) -> DataFrame:
    """Take tide and atmospheric loading off floating points; flag them in floating.

    tide_ocean holds the predicted tide. Grounded points and missing values count as zero.
    The adjustment grid scale (field v) weakens both terms where it is not zero.
    """
    out = interp2(points, mask, {"mask": "_m"}, spacing)
    on = F.coalesce(F.col("_m") > 0.5, F.lit(False))
    out = out.withColumn("floating", on).drop("_m")
    factor = F.lit(1.0)
    if scale is not None:
        out = interp2(out, scale, {"v": "tide_adj_scale"}, scale_spacing or spacing)
        out = out.withColumn(
            "tide_adj_scale", F.when(F.col("floating"), F.col("tide_adj_scale")).otherwise(0.0)
        )
        factor = F.when(F.col("tide_adj_scale") == 0, 1.0).otherwise(F.col("tide_adj_scale"))
    zero = F.lit(0.0)
    out = out.withColumns({
        c: F.when(F.col("floating"), F.coalesce(F.col(c) * factor, zero)).otherwise(zero)
        for c in ("tide_ocean", "dac")
    })
    return out.withColumn("z", F.col("z") - (F.col("tide_ocean") + F.col("dac")))


def _near_points(
    model: DataFrame, points: DataFrame, spacing: float, t_start: float, t_step: float, pad: int
) -> DataFrame:
    """Cells of a model within pad cells of a point, in the epochs around those points.

    Cells are kept by bins of pad cells: those that hold points and the bins beside them.
    """
    bins = points.select(
        F.floor(F.col("x") / (spacing * pad)).alias("_i"),
        F.floor(F.col("y") / (spacing * pad)).alias("_j"),
        ((F.col("time") - t_start) / t_step).alias("_t"),
    )
    spans = bins.groupBy("_i", "_j").agg(F.floor(F.min("_t")).alias("_a"), (F.floor(F.max("_t")) + 1).alias("_b"))
    for c in ("_i", "_j"):
        beside = F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)]))
        spans = spans.withColumn(c, beside)
    spans = spans.groupBy("_i", "_j").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    cells = model.withColumns({
        "_i": F.floor(F.col("ix") / pad), "_j": F.floor(F.col("iy") / pad)})
    kept = attach(cells, spans, ["_i", "_j"], "inner").where(F.col("it").between(F.col("_a"), F.col("_b")))
    return kept.drop("_i", "_j", "_a", "_b")


def firn_correction(
    points: DataFrame, model: DataFrame, spacing: float, t_start: float, t_step: float,
    fields: dict[str, str] | None = None, infer_fac: bool = False, rho_water: float = WATER_DENSITY,
    subset_valid: bool = False, width: float = 1.0,
) -> DataFrame:
    """Correct heights for firn and mass changes of a gridded model, undoing an older one.

    Gaps of the model are filled per epoch before it is interpolated; fields maps the names
    SMB_a and FAC (or h_a, from which FAC is inferred) to model columns. Only the model's cells
    and epochs near points are filled and joined.
    """
    second = "h_a" if infer_fac else "FAC"
    fields = fields or {"SMB_a": "SMB_a", second: second}
    names = list(fields.values())
    near = _near_points(model, points, spacing, t_start, t_step, math.ceil(4 * width) + 2)
    filled = fill_gaps(near, names, width, ["it"])
    out = interp3(
        points, filled, {fields["SMB_a"]: "_smb", fields[second]: "_other"}, spacing,
        t_start, t_step,
    )
    floating = F.col("floating") if "floating" in points.columns else None
    other = F.col("_other")
    new = firn_height(
        F.col("_smb"), None if infer_fac else other, other, floating, rho_water
    )
    old = F.col("h_firn") if "h_firn" in points.columns else None
    out = out.withColumns({"z": recorrect(F.col("z"), new, old), "h_firn": new})
    if subset_valid:
        out = out.where("h_firn is not null")
    return out.drop("_smb", "_other")


def apply_rock(
    mask: DataFrame, rock: DataFrame, mask_spacing: float, rock_spacing: float, reject: int
) -> DataFrame:
    """Zero all epochs of the mask cells that are rock; rock holds a class field."""
    rejected = rock.withColumn("_rock", (F.col("class") == reject).cast("double"))
    cells = mask.select("ix", "iy").distinct().withColumns({
        "_x": F.col("ix") * F.lit(float(mask_spacing)),
        "_y": F.col("iy") * F.lit(float(mask_spacing)),
    })
    cells = interp2(cells, rejected, {"_rock": "_r"}, rock_spacing, x="_x", y="_y")
    out = attach(mask, cells.select("ix", "iy", "_r"), ["ix", "iy"])
    is_rock = F.coalesce(F.col("_r") > 0.5, F.lit(False))
    return out.withColumn("mask", F.when(is_rock, 0).otherwise(F.col("mask"))).drop("_r")


def geoid_on_cells(
    z0: DataFrame, geoid: DataFrame, geoid_spacing: float, lat: Column, lon: Column
) -> DataFrame:
    """Mean-tide geoid height at cells; the geoid grid is in whole steps of degrees."""
    at = z0.withColumns({"_lon": F.pmod(lon, F.lit(360.0)), "_lat": lat})
    at = interp2(at, geoid, {"geoid_h": "_g"}, geoid_spacing, x="_lon", y="_lat")
    return at.withColumn("geoid_z", geoid_mean_tide(F.col("_lat"), F.col("_g"))).drop(
        "_lon", "_lat", "_g"
    )


def mask_below_geoid(
    z0: DataFrame, dz: DataFrame, z0_spacing: float, dz_spacing: float
) -> tuple[DataFrame, DataFrame]:
    """Clear the masks of cells whose surface lies below the geoid; z0 holds geoid_z.

    For dz this is decided per epoch, and clears the cell area too.
    """
    base = z0.select("ix", "iy", "z0", "geoid_z")
    below = F.coalesce(F.col("z0") < F.col("geoid_z"), F.lit(False))
    z0 = z0.withColumn("mask", F.when(below, 0).otherwise(F.col("mask")))
    cells = dz.select("ix", "iy").distinct().withColumns({
        "_x": F.col("ix") * F.lit(float(dz_spacing)), "_y": F.col("iy") * F.lit(float(dz_spacing))
    })
    cells = interp2(
        cells, base, {"z0": "_z0", "geoid_z": "_geoid"}, z0_spacing, x="_x", y="_y"
    ).drop("_x", "_y")
    out = attach(dz, cells, ["ix", "iy"])
    above = F.coalesce(F.col("_z0") + F.col("dz") > F.col("_geoid"), F.lit(False))
    return z0, out.withColumns({
        "mask": F.when(above, F.col("mask")).otherwise(0),
        "cell_area": F.when(above, F.col("cell_area")).otherwise(0.0),
    }).drop("_z0", "_geoid")


def classify_mask(grid: DataFrame, field: str = "class") -> DataFrame:
    """Land-cover classes to an ice mask (2 grounded, 3 floating) and a shelf mask (3)."""
    c = F.coalesce(F.col(field).cast("double"), F.lit(0.0))
    shelf = F.abs(c - 3) < 0.5
    return grid.withColumns({
        "ice": (shelf | (F.abs(c - 2) < 0.5)).cast("int"), "shelf": shelf.cast("int")
    })


def base_ice_mask(
    bed: DataFrame, spacing: float, new_spacing: float, spread: int = 4, opened: int = 10,
    thin: float = 10.0,
) -> DataFrame:
    """Ice cells on a new lattice: not within or near thin non-ice ground.

    bed holds class and thickness. Classes 1 and 2 are spread, kept where the ice is thin,
    regridded; cells under 0.9 of that are ice, and narrow parts are removed.
    """
    near = F.col("class").isin(1, 2).cast("int")
    wide = dilate(bed.withColumn("_near", near), spread, spread, "_near")
    # comparing a missing thickness gives no ice edge
    edge = (F.col("_near") == 1) & F.coalesce(F.col("thickness") < thin, F.lit(False))
    marked = wide.select("ix", "iy", edge.cast("double").alias("_edge"))
    cells = regrid(marked, ["_edge"], spacing, new_spacing)
    ice = F.coalesce((F.col("_edge") < 0.9).cast("int"), F.lit(0))
    return open_mask(cells.select("ix", "iy", ice.alias("mask")), opened)


def select_bands(bands: DataFrame) -> DataFrame:
    """Mask bands of all sources in use: after the start, without the epoch left out.

    Where sources share an epoch, the last listed source (highest source) counts.
    """
    tenth = F.rint(F.col("t") / 0.1) * 0.1
    used = bands.where((F.col("t") > BANDS_AFTER) & (F.abs(tenth - BAND_DROPPED) > 1e-6))
    last = used.groupBy("ix", "iy", "t").agg(F.max_by("mask", "source").alias("mask"))
    value = F.col("mask")
    clean = F.when(value.isNull() | (value == 255) | (value == 0), 0).otherwise(1)
    return last.withColumn("mask", clean)


def compose_mask(
    bands: DataFrame, base: DataFrame, add: DataFrame, remove: DataFrame,
    retreat: DataFrame, advance: DataFrame, retreat_t: float, spacing: float,
) -> DataFrame:
    """Time-varying ice mask of bands, patches, dated polygons and a base mask.

    In order: set cells of add before its year; clear cells of remove after its year; clear
    the retreat polygon; before retreat_t set the latest earlier advance polygon (version_t);
    keep only cells of the base mask.
    """
    out = select_bands(bands)

    def flag(edges: DataFrame, name: str) -> DataFrame:
        cells = rasterize(edges, spacing, ["poly_id"]).select("ix", "iy").distinct()
        return cells.withColumn(name, F.lit(1))

    for edges, name in ((add, "_add"), (remove, "_remove"), (retreat, "_retreat")):
        out = attach(out, flag(edges, name), ["ix", "iy"])
    out = asof_before(out, advance.select("version_t"))
    shown = rasterize(advance, spacing, ["poly_id", "version_t"])
    shown = shown.select("ix", "iy", "version_t").distinct().withColumn("_shown", F.lit(1))
    out = attach(out, shown, ["ix", "iy", "version_t"])
    out = attach(out, base.select("ix", "iy", F.col("mask").alias("_base")), ["ix", "iy"])
    t, value = F.col("t"), F.col("mask")
    value = F.when((t < PATCH_ADD_BEFORE) & F.col("_add").isNotNull(), 1).otherwise(value)
    value = F.when((t > PATCH_REMOVE_AFTER) & F.col("_remove").isNotNull(), 0).otherwise(value)
    value = F.when(F.col("_retreat").isNotNull(), 0).otherwise(value)
    value = F.when((t < retreat_t) & F.col("_shown").isNotNull(), 1).otherwise(value)
    value = F.when(F.col("_base") == 1, value).otherwise(0)
    return out.select("ix", "iy", "t", value.alias("mask"))


def matching_bands(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bands of two files with the same time: t and the band number in each."""
    left = a.select("t", F.col("band").alias("band_a"))
    return left.join(b.select("t", F.col("band").alias("band_b")), "t")


def mask_persistence(mask: DataFrame) -> DataFrame:
    """Number of epochs in which each cell is set."""
    return mask.groupBy("ix", "iy").agg(F.sum("mask").alias("n_epochs"))


def repeat_in_time(mask: DataFrame, t_first: float, t_last: float) -> DataFrame:
    """A mask without time, at yearly epochs from a year before the span to a year after."""
    n = int(-(-(t_last + 1 - (t_first - 1)) // 1))
    years = F.array(*[F.lit(t_first - 1 + i) for i in range(n)])
    return mask.withColumn("t", F.explode(years))


def extend_mask(mask: DataFrame, t_end: float) -> DataFrame:
    """Repeat the last band yearly until the epochs reach t_end."""
    return band_extension(mask, t_end)
