"""Pick the rows that may have one of many keys without a shuffle of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24


def sieve(keys: DataFrame, key: str, bits: int = BITS):
    """A test of a 64-bit column: true for all of the keys, and for few other values.

    The keys are summed to a bit map of fixed size (bits / 8 bytes), which is all that reaches
    the driver and the tasks. With more keys than bits it lets ever more rows pass, so an exact
    join must follow. Runs a job.
    """
    word = F.shiftrightunsigned(F.pmod(F.col(key), F.lit(bits)).cast("int"), 6)
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{key}`, 64) as int))")
    rows = keys.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in values:
            at = np.mod(part.to_numpy(np.int64), bits)
            hit = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield pd.Series(hit.astype(bool))

    def test(column: Column) -> Column:
        return passes.asNondeterministic()(column)

    return test
