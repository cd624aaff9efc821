"""Fill values and rounding of written products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest value of each type marks a missing cell in a written product.
FILL = {
    "double": 1.7976931348623157e308,
    "float": 3.4028234663852886e38,
    "int": 2147483647,
    "tinyint": 127,
}


def fill_value(c: Column, dtype: str) -> Column:
    return F.coalesce(c.cast(dtype), F.lit(FILL[dtype]).cast(dtype))


def unfill(c: Column, limit: float = 1e16) -> Column:
    """NULL for the huge values that mark missing cells."""
    return F.when(F.abs(c) <= limit, c)


def quantize(c: Column, digits: int) -> Column:
    """Round to the power of two that keeps the given number of decimal digits."""
    bits = 0
    while 2**bits < 10**digits:
        bits += 1
    return F.rint(c * 2.0**bits) / 2.0**bits
