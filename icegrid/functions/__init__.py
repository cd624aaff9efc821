"""Column expressions; all of them stay inside generated JVM code."""

from icegrid.functions.binning import (
    bin_centre,
    bin_index,
    npmod,
    parent_tile,
    parse_tile_name,
    tile_name,
)
from icegrid.functions.heights import (
    clamp_param,
    firn_height,
    geoid_mean_tide,
    global_ref_pt,
    recorrect,
    sigma_corr,
)
from icegrid.functions.names import parse_granule_name
from icegrid.functions.polar import cell_area, polar_latlon, polar_scale, polar_xy
from icegrid.functions.product import fill_value, quantize, unfill
from icegrid.functions.timebase import (
    date_decimal_year,
    days_since_2018,
    decimal_year,
    nominal_quarter,
    timestamp_of_year,
    year_of_timestamp,
)

__all__ = [
    "bin_centre", "bin_index", "cell_area", "clamp_param", "date_decimal_year",
    "days_since_2018", "decimal_year", "fill_value", "firn_height", "geoid_mean_tide",
    "global_ref_pt", "nominal_quarter", "npmod", "parent_tile", "parse_granule_name",
    "parse_tile_name", "polar_latlon", "polar_scale", "polar_xy", "quantize", "recorrect",
    "sigma_corr", "tile_name", "timestamp_of_year", "unfill", "year_of_timestamp",
]
