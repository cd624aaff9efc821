"""Gridded inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from icegrid.operators.interp import crop_grid


def read_grid(
    spark: SparkSession, path: str, box: tuple[float, float, float, float], pad: float = 0.0,
    t_range: tuple[float, float] | None = None, t_step: float | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Cells of a grid table near a box and time range; both limits reach the file scan."""
    grid = crop_grid(spark.read.parquet(path), box, pad, t_range, t_step)
    if fields is None:
        return grid
    place = [c for c in ("ix", "iy", "it", "x", "y", "t") if c in grid.columns]
    return grid.select(*place, *fields)


def split_bands(grid: DataFrame, path: str) -> None:
    """One folder per epoch, named by its time."""
    grid.hint("rebalance", "t").write.mode("overwrite").partitionBy("t").parquet(path)


def write_product(df: DataFrame, path: str) -> None:
    """A product in folders by scale and lag."""
    df.hint("rebalance", "scale_m", "lag").write.mode("overwrite").partitionBy(
        "scale_m", "lag"
    ).parquet(path)
