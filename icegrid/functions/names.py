"""Attributes held in input file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two file name formats after the product's code. Track, region, first and last
# cycle, release, version; and for crossovers cycle, release, version.
TRACK_FILE = r"_(\d{4})(\d{2})_(\d{2})(\d{2})_(\d{3})_(\d{2}).*?\.h5$"
CROSSOVER_FILE = r"xo)_.._E.*_N.*_c(\d\d)_(\d\d\d)_(\d\d)\.h5$"
ANY_PRODUCT = r"[A-Z]{3}\d{2}"

TRACK_FIELDS = (
    "short_name", "start_rgt", "start_region", "start_cycle", "end_cycle", "release", "version",
)
CROSSOVER_FIELDS = {"short_name": 1, "start_cycle": 2, "end_cycle": 2, "release": 3, "version": 4}


def parse_granule_name(name: Column, product: str = ANY_PRODUCT) -> dict[str, Column]:
    """Columns by attribute; NULL where the format has no such attribute.

    product is the code that names start with, as a pattern; files of others are not parsed.
    """
    track_file, crossover_file = f"({product}){TRACK_FILE}", f"({product}{CROSSOVER_FILE}"
    is_track, is_xover = name.rlike(track_file), name.rlike(crossover_file)
    out = {}
    for group, field in enumerate(TRACK_FIELDS, start=1):
        value = F.when(is_track, F.regexp_extract(name, track_file, group))
        if field in CROSSOVER_FIELDS:
            other = F.regexp_extract(name, crossover_file, CROSSOVER_FIELDS[field])
            value = value.when(is_xover, other)
        out[field] = value
    return out
