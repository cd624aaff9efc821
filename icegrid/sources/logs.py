"""Reports from the text logs of tile jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The formats of log names and lines.
JOB = r"_(\d+)(?:\.log)?$"
TILE = r"working on .*E(.*)_N(.*)\.h5"
USED = r"Memory Used.* (\d+)K"
LIMIT = r"memory limit\s+.(\d+)"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with their number; lines of a file keep their order by offset."""
    df = spark.read.text(path)
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"),
    )


def log_report(lines: DataFrame) -> DataFrame:
    """Per log: job, tile centre in km (first named), memory used and limit (last named), state.

    A job with two tiles done, or one done and no trouble, is complete. Killed outranks error.
    """

    def found(pattern: str, group: int = 1):
        v = F.regexp_extract("line", pattern, group)
        return F.when(v != "", v)

    low = F.lower("line")
    rows = lines.select(
        "file", "line_no",
        F.when(found(TILE).isNotNull(), F.struct(
            found(TILE, 1).alias("x"), found(TILE, 2).alias("y"))).alias("tile"),
        found(USED).try_cast("long").alias("used"),
        found(LIMIT).try_cast("long").alias("limit"),
        low.contains("killed").alias("killed"), low.contains("error").alias("error"),
        F.col("line").contains("done with").alias("done"),
    )

    def last(c: str):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("line_no")))

    out = rows.groupBy("file").agg(
        F.min_by("tile", F.when(F.col("tile").isNotNull(), F.col("line_no"))).alias("_tile"),
        last("used").alias("memory_used_k"), last("limit").alias("memory_limit_k"),
        F.bool_or("killed").alias("_killed"), F.bool_or("error").alias("_error"),
        F.count(F.when(F.col("done"), 1)).alias("n_done"),
    )
    state = (
        F.when(F.col("n_done") > 1, "complete")
        .when(F.col("_killed"), "killed").when(F.col("_error"), "error")
        .when(F.col("n_done") > 0, "complete").otherwise("not run")
    )
    return out.select(
        "file", F.regexp_extract("file", JOB, 1).alias("job"),
        F.col("_tile.x").try_cast("int").alias("x_km"), F.col("_tile.y").try_cast("int").alias("y_km"),
        "memory_used_k", "memory_limit_k", "n_done", state.alias("state"),
    )
