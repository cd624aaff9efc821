"""Order statistics, ranks and running sums that never gather one key in one task.

Sums, counts, extremes and min_by combine before the shuffle, so a hot key is harmless there.
Exact quantiles, ranks and running sums do not; the functions below split the key by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icegrid.session import cut_lineage

# Largest group whose values the built-in percentile may hold in one task.
GROUP_ROWS = 1 << 20
SPLITTERS = 256
# Most keys of large groups that are broadcast; beyond it they are joined like any table.
BROADCAST_KEYS = 100_000
# Most keys of numbers alone whose list is sent to all tasks.
TOLD_KEYS = 1 << 19
# Hash values by which rows are counted to find out whether any key is crowded.
BUCKETS = 1 << 16


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Equality on all keys in which two NULLs match, as they do in a grouping."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def attach(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a table with one row per key to the rows; NULL keys match, as in a grouping.

    Spark measures the table and sends it to the rows if it is small; otherwise both sides are
    shuffled and oversized partitions of the rows are split (see session.SETTINGS). Spark only
    splits a join whose two sides were both shuffled for it. A plain equality would take over
    the partitioning of the grouping that made the table; this one does not.
    """
    extra = [c for c in table.columns if c not in keys]
    joined = df.alias("l").join(table.alias("r"), same_key("l", "r", keys), how)
    return joined.select("l.*", *[F.col(f"r.{c}") for c in extra])


def keep(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is in the table; split like attach."""
    cond = same_key("l", "r", keys)
    return df.alias("l").join(table.select(*keys).alias("r"), cond, "left_semi")


def leave(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not in the table; split like attach."""
    cond = same_key("l", "r", keys)
    return df.alias("l").join(table.select(*keys).alias("r"), cond, "left_anti")


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def crowded_buckets(df: DataFrame, keys: list[str], most: int) -> list[int]:
    """Buckets of keys with over most rows; if there is none, no key has so many.

    Runs one job that shuffles a bounded number of counts for each task, however many keys there are.
    """
    counts = df.groupBy(_bucket(keys).alias("_b")).agg(F.count("*").alias("_n"))
    return [r["_b"] for r in counts.where(F.col("_n") > most).select("_b").collect()]


def with_group_median(
    df: DataFrame, keys: list[str], value: Column, name: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """The rows with the exact median of their group; runs a job that counts.

    Unless a group is crowded the rows are shuffled once, and each group gets its median where it lies.
    """
    if crowded_buckets(df, keys, group_rows):
        return attach(df, group_median(df, keys, value, name, group_rows=group_rows), keys)
    middle = F.percentile(value.cast("double"), 0.5).over(Window.partitionBy(*keys))
    return df.withColumn(name, middle)


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: Column,
    probs: dict[str, float],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group; one row per group with any value.

    Runs one job, that counts rows by hashed group. Groups up to group_rows are brought together
    and go through the built-in aggregate: states of it would take more room than the values. Larger ones, at most rows / group_rows, are narrowed to the values around the
    wanted rank, twice by a factor of about SPLITTERS, before anything is sorted. Their keys
    are broadcast if they count few.
    """
    vals = df.select(*keys, value.cast("double").alias("_v")).where("_v is not null")
    exact = [F.percentile("_v", p).alias(name) for name, p in probs.items()]
    together = lambda rows: rows.repartition(*keys) if keys else rows
    full = crowded_buckets(vals, keys, group_rows) if keys else [0]
    if not full:
        return together(vals).groupBy(*keys).agg(*exact)
    some = vals.where(_bucket(keys).isin(full)) if keys else vals
    hot = some.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > group_rows)
    hot = cut_lineage(hot)
    if hot.isEmpty():
        return together(vals).groupBy(*keys).agg(*exact)
    if hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    few = together(leave(vals, hot, keys)).groupBy(*keys).agg(*exact)
    many = attach(vals, hot, keys, "inner")
    picked = None
    for name, p in probs.items():
        one = _select_rank(many, keys, p).withColumnRenamed("_q", name)
        picked = one if picked is None else attach(picked, one, keys, "inner")
    return few.unionByName(picked)


def group_median(df: DataFrame, keys: list[str], value: Column, name: str, **kw) -> DataFrame:
    return group_quantiles(df, keys, value, {name: 0.5}, **kw)


def _select_rank(rows: DataFrame, keys: list[str], p: float) -> DataFrame:
    pos = (F.col("_n") - 1) * F.lit(float(p))
    rows = rows.select(
        *keys, "_v", F.floor(pos).alias("_k"), (pos - F.floor(pos)).alias("_frac")
    )
    for _ in range(2):
        rows = _narrow(rows, keys)
    counts = rows.groupBy(*keys, "_k", "_frac", "_v").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.sum("_c").over(order))
    low = F.min(F.when(F.col("_upto") > F.col("_k"), F.col("_v")))
    high = F.min(F.when(F.col("_upto") > F.col("_k") + 1, F.col("_v")))
    frac = F.first("_frac")
    return upto.groupBy(*keys).agg(
        (low + (F.coalesce(high, low) - low) * frac).alias("_q")
    )


def _narrow(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the values in the one or two buckets that hold ranks k and k + 1."""
    grid = [i / SPLITTERS for i in range(1, SPLITTERS)]
    cuts = rows.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx("_v", grid, 4 * SPLITTERS)).alias("_cuts")
    )
    bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    rows = attach(rows, cuts, keys, "inner")
    rows = rows.withColumn("_b", bucket).drop("_cuts")
    sums = rows.groupBy(*keys, "_k", "_b").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_c").over(order), F.lit(0)))
    end = F.col("_before") + F.col("_c")
    wanted = sums.where((F.col("_before") <= F.col("_k") + 1) & (end > F.col("_k")))
    first = wanted.groupBy(*keys).agg(F.min("_before").alias("_skip"))
    wanted = attach(wanted.drop("_k", "_c", "_before"), first, keys, "inner")
    rows = attach(rows, wanted, [*keys, "_b"], "inner")
    return rows.withColumn("_k", F.col("_k") - F.col("_skip")).drop("_b", "_skip")


def rank_distinct(
    df: DataFrame, keys: list[str], value: str, name: str, block: int = 4096
) -> DataFrame:
    """0-based rank of each distinct whole-number value in its group.

    Values are ranked in blocks of consecutive numbers, so no task sorts more than block of
    them; each block then starts at the number of values in the blocks below.
    """
    vals = df.select(*keys, value).distinct()
    vals = vals.withColumn("_block", F.floor(F.col(value) / block))
    sizes = vals.groupBy(*keys, "_block").agg(F.count("*").alias("_c"))
    below = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_c").over(below), F.lit(0))).drop("_c")
    inside = Window.partitionBy(*keys, "_block").orderBy(value)
    ranked = attach(vals.withColumn("_r", F.row_number().over(inside) - 1), starts,
                    [*keys, "_block"], "inner")
    return ranked.select(*keys, value, (F.col("_r") + F.col("_start")).alias(name))


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Row numbers from 1 in an order that must be total.

    The rows are sorted over all tasks and stored; a row's number is its place in its part
    plus the sizes of the parts before. Runs a job.
    """
    stored = cut_lineage(df.orderBy(*order))
    part, bits = F.spark_partition_id(), 33
    rows = stored.select(
        "*", part.alias("_part"),
        (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), bits)).alias("_i"),
    )
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_c"))
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_c").over(below), F.lit(0)).alias("_start"))
    out = attach(rows, starts, ["_part"], "inner")
    return out.select(*df.columns, (F.col("_i") + F.col("_start") + 1).alias(name))
