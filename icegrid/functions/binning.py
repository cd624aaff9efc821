"""Bins, tiles and tile names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TILE_NAME = r"E(.*)_N(.*)\.h5"  # fixed value: the tile file name format, centres in km


def bin_index(v: Column, width: float, origin: float = 0.0) -> Column:
    """Index of the nearest bin centre, counted from the centre at origin; halves go to even."""
    return F.rint((v - origin) / width).cast("int")


def bin_centre(v: Column, width: float) -> Column:
    """Centre of the bin whose edges lie on multiples of width."""
    half = width / 2
    return F.rint((v - half) / width) * width + half


def parent_tile(v: Column, width: float = 2e5) -> Column:
    """Centre of the tile, with edges on multiples of width, that holds v."""
    return F.floor(v / width) * width + width / 2


def npmod(v: Column, width: float) -> Column:
    """Remainder with the sign of width."""
    return F.pmod(v, F.lit(width))


def tile_name(x0: Column, y0: Column) -> Column:
    km_x, km_y = (x0 / 1000).cast("long"), (y0 / 1000).cast("long")
    return F.format_string("E%d_N%d.h5", km_x, km_y)


def parse_tile_name(name: Column) -> tuple[Column, Column]:
    """Centre in metres from a name or path; NULL where the name has another form."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return tuple(
        F.regexp_extract(base, TILE_NAME, i).try_cast("double") * 1000 for i in (1, 2)
    )
