"""Height points in spatial bins."""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icegrid.operators.filters import Box, in_box
from icegrid.operators.points import XOVER_KEYS, best_xover, join_xover_groups

BIN_M = 2e5  # width of the bins that are folders of the point table
LEAF_ROWS = 4_000_000  # rows per file; a crowded bin becomes several files

_DOUBLES = [
    "latitude", "longitude", "delta_time", "h_corr", "h_corr_sigma", "h_corr_sigma_systematic",
    "tide_ocean", "dac", "e_slope", "n_slope", "x_atc", "dem_h", "geoid_h",
]
ALONG_TRACK = T.StructType(
    [
        T.StructField("file", T.StringType()), T.StructField("pair", T.IntegerType()),
        T.StructField("rgt", T.IntegerType()), T.StructField("ref_pt", T.LongType()),
        T.StructField("cycle", T.IntegerType()), T.StructField("fit_quality", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in _DOUBLES]
)


def with_bins(df: DataFrame, bin_m: float = BIN_M) -> DataFrame:
    return df.withColumns({
        "bx": F.floor(F.col("x") / bin_m).cast("int"),
        "by_": F.floor(F.col("y") / bin_m).cast("int"),
    })


def write_binned(df: DataFrame, path: str, bin_m: float = BIN_M) -> None:
    """Write points in folders by bin, ordered by place within files.

    Rebalancing joins small bins in a task and splits a crowded one, whatever fills it.
    """
    binned = with_bins(df, bin_m).hint("rebalance", "bx", "by_")
    binned = binned.sortWithinPartitions("bx", "by_", "x")
    writer = binned.write.mode("overwrite").option("maxRecordsPerFile", LEAF_ROWS)
    writer.partitionBy("bx", "by_").parquet(path)


def bin_counts(df: DataFrame, bin_m: float = BIN_M) -> DataFrame:
    """The index of the binned table: points per bin."""
    return with_bins(df, bin_m).groupBy("bx", "by_").agg(F.count("*").alias("n"))


def in_bins(df: DataFrame, box: Box, bin_m: float = BIN_M) -> DataFrame:
    """Bins that meet the box; on a binned table this prunes folders before any file is read."""
    return df.where(
        F.col("bx").between(floor(box[0] / bin_m), floor(box[1] / bin_m))
        & F.col("by_").between(floor(box[2] / bin_m), floor(box[3] / bin_m))
    )


def read_points(
    spark: SparkSession, path: str, box: Box, cols: list[str], bin_m: float = BIN_M,
    with_file: bool = False,
) -> DataFrame:
    """The named columns of the points in a closed box, with their file if asked for."""
    df = in_box(in_bins(spark.read.parquet(path), box, bin_m), box)
    if with_file:
        return df.select(*cols, F.input_file_name().alias("input_file"))
    return df.select(*cols)


XOVER_GROUPS = ("root", "crossing", "datum")


def write_xovers(
    root: DataFrame, crossing: DataFrame, datum: DataFrame, path: str, bin_m: float = BIN_M
) -> None:
    """The row-aligned crossover tables, all in folders by the bin of the crossover."""
    place = root.select("file", "row_id", "x", "y")
    write_binned(root, f"{path}/root", bin_m)
    for name, df in (("crossing", crossing), ("datum", datum)):
        write_binned(df.join(place, ["file", "row_id"]), f"{path}/{name}", bin_m)


def read_xovers(
    spark: SparkSession, path: str, box: Box, cycles: tuple[int, ...] = (1, 2),
    bin_m: float = BIN_M,
) -> DataFrame:
    """Best crossover points in a box; folders of all three tables are pruned.

    All input files of all cycles count.
    """
    root, crossing, datum = (
        in_box(in_bins(spark.read.parquet(f"{path}/{name}"), box, bin_m), box).drop("bx", "by_")
        for name in XOVER_GROUPS
    )
    root = root.where(F.col("cycle").isin(*cycles))
    rows = join_xover_groups(root, crossing.drop("x", "y"), datum.drop("x", "y"))
    return best_xover(rows, ["file", "row_id"], XOVER_KEYS)
