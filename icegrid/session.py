"""Session settings, durable lineage cuts and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins here attach a table with one row per key to many rows. With these on, Spark splits
# an oversized partition of the many-row side at run time, also when all its rows share a key.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # what a job shuffled is removed when its result is written or stored, not when the driver
    # next collects its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if _local_dirs.get(app) is None:
        _local_dirs[app] = tempfile.mkdtemp(prefix="icegrid-")
    return _local_dirs[app]


_local_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def few_parts(spark: SparkSession, size: int) -> int:
    """Parts for a table of about size bytes: of 32 MB, and two at least for each core."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-size // (32 << 20)))


def cut_lineage(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Reliable checkpoint, so that a lost executor does not replay every earlier pass.

    With parts given, the table is written as so many files. The rows are dealt to them by a
    shuffle: a task that ran many parts of a join one after the other would keep the memory of
    their sorts until its end.
    """
    spark = df.sparkSession
    if parts:
        df = df.repartition(parts)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(_shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once in the shared folder as a table of columns.

    Takes much less room than a checkpoint of wide rows, and later steps read only the columns
    they need. Columns without a type hold nothing and are not written.
    """
    empty = [c for c, t in df.dtypes if t == "void"]
    held = df.drop(*empty)
    path = scratch_dir(df.sparkSession, name)
    held.write.parquet(path)
    back = df.sparkSession.read.schema(held.schema).parquet(path)
    return back.select(*[F.lit(None).alias(c) if c in empty else F.col(f"`{c}`") for c in df.columns])


def gathered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key brought together, so that sums by finer keys combine before their shuffle.

    Rows that come in no order of place would otherwise reach it almost one by one. A key with
    very many rows is split over tasks: the key is dropped again, so nothing later relies on it.
    """
    columns = df.columns
    marked = df.withColumn("_home", F.xxhash64(*keys))
    return marked.hint("rebalance", "_home").select(*columns)


def by_group(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows spread by key over all shuffle partitions.

    Groups that cost much time but few bytes would otherwise be merged into few tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
