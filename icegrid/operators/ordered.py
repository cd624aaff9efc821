"""Operators along time or track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icegrid.operators.skew import GROUP_ROWS, attach, crowded_buckets
from icegrid.session import stored

# Lags in epochs of quarterly and of monthly products, and the first year.
QUARTER_LAGS = (1, 4, 8, 12, 16, 20, 24)
MONTH_LAGS = (1, 3, 6, 12)
FIRST_YEAR, LAST_YEAR = 2019.0, 2050.0


def lagged_rate(
    dz: DataFrame, lags: tuple[int, ...] = QUARTER_LAGS, dt: float = 0.25,
    field: str = "dz", cell: list[str] | None = None, carry: list[str] | None = None,
) -> DataFrame:
    """Rates of change over each lag, at the middle of the interval; t is the epoch's time.

    A cell has one row per epoch, so a window over a cell is as long as the epoch axis. The
    window runs over epoch numbers: a missing epoch gives no rate, never a longer interval.
    carry names fields to take from both ends; their smaller value stays.
    """
    cell = cell or ["ix", "iy"]
    line = Window.partitionBy(*cell).orderBy("it")
    # one range frame per lag picks the row exactly that many epochs later, if it exists
    items = []
    for lag in lags:
        ahead = line.rangeBetween(lag, lag)
        dts = lag * dt
        rate = (F.max(field).over(ahead) - F.col(field)) / F.lit(float(dts))
        parts = [
            F.lit(lag).alias("lag"), (F.col("t") + dts / 2).alias("t_mid"), rate.alias("rate"),
        ]
        parts += [F.least(F.col(c), F.max(c).over(ahead)).alias(c) for c in carry or []]
        items.append(F.when(F.count(F.lit(1)).over(ahead) > 0, F.struct(*parts)))
    wide = dz.select(*cell, "it", F.array(*items).alias("_lags"))
    long = wide.withColumn("_r", F.explode("_lags")).where("_r is not null")
    return long.select(
        *cell, "it", "_r.lag", F.col("_r.t_mid").alias("t"), F.col("_r.rate").alias("dzdt"),
        *[F.col(f"_r.{c}") for c in carry or []],
    ).where("dzdt is not null")


def crop_time(df: DataFrame, dt: float = 0.25) -> DataFrame:
    """Epochs of the product: rates start half their interval after the first year."""
    start = FIRST_YEAR + dt * F.coalesce(F.col("lag"), F.lit(0)) / 2
    return df.where(F.col("t").between(start, F.lit(LAST_YEAR)))


def rereference(
    dz: DataFrame, t_ref: float, field: str = "dz", cell: list[str] | None = None
) -> DataFrame:
    """Changes since the epoch nearest t_ref (the earlier of two), where they become zero."""
    cell = cell or ["ix", "iy"]
    near = F.struct(F.abs(F.col("t") - t_ref), F.col("it"))
    ref = dz.groupBy(*cell).agg(F.min_by(field, near).alias("_ref"))
    out = attach(dz, ref, cell)
    return out.withColumn(field, F.col(field) - F.col("_ref")).drop("_ref")


def band_extension(mask: DataFrame, t_end: float, t: str = "t") -> DataFrame:
    """Copies of the last epoch, a year apart, until the epochs reach t_end."""
    last = mask.groupBy().agg(F.max(t).alias("_t"))
    tail = mask.join(last, mask[t] == last["_t"])
    extra = F.greatest(F.ceil(F.lit(float(t_end)) - F.col("_t")), F.lit(0)).cast("int")
    tail = tail.where(extra > 0).withColumn("_k", F.explode(F.sequence(F.lit(1), extra)))
    tail = tail.withColumn(t, F.col("_t") + F.col("_k"))
    return mask.unionByName(tail.select(*mask.columns))


def track_segments(
    points: DataFrame, dn: int, track: list[str] | None = None, min_fill: float = 0.9,
) -> DataFrame:
    """Choose one cycle for each overlapping segment of a track.

    Centres lie every dn / 2 reference points from half that past the first point, up to the
    last; members are within 1.5 dn. Each (reference point, cycle) counts once, with its mean
    height. Segments whose fullest cycle has under min_fill * dn points are skipped; of the cycles
    within 5 of the fullest, the one with the smallest median along-track step is taken.
    Unless a track has very many points in a cycle, these are brought to one task. Runs a job.
    """
    track = track or ["rgt", "pair"]
    node = points.groupBy(*track, "cycle", "ref_pt").agg(F.avg("z").alias("z"))
    ends = node.groupBy(*track).agg(
        F.min("ref_pt").alias("_p0"), F.max("ref_pt").alias("_p1")
    )
    half = dn / 2
    low = F.floor((F.col("ref_pt") - 1.5 * dn - F.col("_p0") - half) / half) + 1
    high = F.ceil((F.col("ref_pt") + 1.5 * dn - F.col("_p0") - half) / half) - 1
    most = F.ceil((F.col("_p1") - F.col("_p0") - half) / half) - 1
    span = F.sequence(F.greatest(low, F.lit(0)).cast("int"), F.least(high, most).cast("int"))
    valid = F.greatest(low, F.lit(0)) <= F.least(high, most)
    node = node.where("z is not null")
    seg = attach(node, ends, track)
    if not crowded_buckets(node, [*track, "cycle"], GROUP_ROWS):
        # a point is moved once, not once for each of its segments
        seg = seg.repartition(*track, "cycle")
    seg = seg.withColumn("seg", F.explode(F.when(valid, span)))
    seg = seg.withColumn("pt0", F.col("_p0") + half + F.col("seg") * half).drop("_p0", "_p1")
    keys = [*track, "seg", "pt0", "cycle"]
    # a segment and cycle holds at most 3 dn reference points
    line = Window.partitionBy(*keys).orderBy("ref_pt")
    seg = seg.withColumn("_d", F.abs(F.col("z") - F.lag("z").over(line)))
    stats = seg.groupBy(*keys).agg(F.count("*").alias("n"), F.median("_d").alias("roughness"))
    place = [*track, "seg", "pt0"]
    # one row per cycle of a segment
    fullest = F.max("n").over(Window.partitionBy(*place))
    stats = stats.withColumn("_max", fullest).where(
        (F.col("_max") >= min_fill * dn) & (F.col("n") >= F.col("_max") - 5)
    )
    order = F.struct(F.col("roughness").isNull(), "roughness", "cycle")
    best = stats.groupBy(*place).agg(F.min_by(F.struct("cycle", "n", "roughness"), order).alias("_b"))
    return best.select(*place, "_b.*")


def interp_at(
    curves: DataFrame, keys: list[str], x: str, lookups: dict[str, tuple[Column, str]],
    loglog: bool = False,
) -> DataFrame:
    """Values of each curve at target x, between the last x below it and the first not below.

    lookups gives, by name, a target and the column to read. A value is NULL if its target is
    not bracketed. A target may use columns that are the same in a whole curve. All lookups
    are made in one pass.
    """
    aggs = []
    for name, (target, y) in lookups.items():
        point = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        aggs += [
            F.max(F.when(F.col(x) < target, point)).alias(f"_lo_{name}"),
            F.min(F.when(F.col(x) >= target, point)).alias(f"_hi_{name}"),
            F.first(target).alias(f"_at_{name}"),
        ]
    best = curves.groupBy(*keys).agg(*aggs)

    def scale(v: Column) -> Column:
        return F.ln(v) if loglog else v

    def value(name: str) -> Column:
        x0, x1, y0, y1 = (
            scale(F.col(f"_{side}_{name}.{c}")) for c in "xy" for side in ("lo", "hi")
        )
        v = y0 + (scale(F.col(f"_at_{name}")) - x0) * (y1 - y0) / (x1 - x0)
        return (F.exp(v) if loglog else v).alias(name)

    return best.select(*keys, *[value(name) for name in lookups])


def _along(
    points: DataFrame, track: list[str], order: str, fields: list[str], block: int
) -> DataFrame:
    """Adds s, the distance along the track, and _to, the distance and fields of the next point.

    Unless a track is crowded, its points are ordered in one task. Else they are ordered within
    blocks of consecutive order numbers, and what blocks hand on is one row each: their first and
    last point and inner length. The points are stored to count them first. Runs jobs.
    """
    points = stored(points, "track")
    if not crowded_buckets(points, track, GROUP_ROWS):
        line = Window.partitionBy(*track).orderBy(order)
        dx, dy = F.col("x") - F.lag("x").over(line), F.col("y") - F.lag("y").over(line)
        rows = points.withColumn("_step", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
        rows = rows.withColumn("s", F.sum("_step").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        return rows.withColumn("_to", F.lead(F.struct("s", *fields)).over(line)).drop("_step")
    keys = [*track, "_block"]
    line = Window.partitionBy(*keys).orderBy(order)
    dx, dy = F.col("x") - F.lag("x").over(line), F.col("y") - F.lag("y").over(line)
    rows = points.withColumn("_block", F.floor(F.col(order) / block))
    rows = rows.withColumn("_step", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
    rows = rows.withColumn(
        "_c", F.sum("_step").over(line.rowsBetween(Window.unboundedPreceding, 0))
    )
    after = F.struct(F.col("_c").alias("s"), *fields)
    rows = rows.withColumn("_next", F.lead(after).over(line))
    ends = rows.groupBy(*keys).agg(
        F.min_by(F.struct("x", "y", *[F.col(f).alias(f"f_{f}") for f in fields]), order).alias("_a"),
        F.max_by(F.struct("x", "y"), order).alias("_z"), F.max("_c").alias("_len"),
    )
    over = Window.partitionBy(*track).orderBy("_block")
    gx = F.col("_a.x") - F.lag("_z.x").over(over)
    gy = F.col("_a.y") - F.lag("_z.y").over(over)
    ends = ends.withColumn("_gap", F.coalesce(F.sqrt(gx * gx + gy * gy), F.lit(0.0)))
    # a block starts after all lengths before it and all gaps up to it
    before = F.coalesce(
        F.sum("_len").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    gaps = F.sum("_gap").over(over.rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("_s0", before + gaps)
    first = F.struct(F.col("_s0").alias("s"), *[F.col(f"_a.f_{f}").alias(f) for f in fields])
    ends = ends.select(*keys, "_s0", F.lead(first).over(over).alias("_exit"))
    rows = attach(rows, ends, keys)
    inner = F.struct(
        (F.col("_next.s") + F.col("_s0")).alias("s"), *[F.col(f"_next.{f}").alias(f) for f in fields]
    )
    rows = rows.withColumns({
        "s": F.col("_s0") + F.col("_c"),
        "_to": F.when(F.col("_next").isNotNull(), inner).otherwise(F.col("_exit")),
    })
    return rows.drop("_block", "_step", "_c", "_next", "_s0", "_exit")


def arc_length(
    points: DataFrame, track: list[str], order: str, block: int = 4096
) -> DataFrame:
    """Distance s along each track from its first point; order is a whole number, unique per track.

    A track of any length is spread over tasks, by blocks of its order numbers.
    """
    return _along(points, track, order, [], block).drop("_to")


def resample_track(
    points: DataFrame, track: list[str], order: str, fields: list[str], step: float = 100.0,
    block: int = 4096,
) -> DataFrame:
    """The fields, linearly interpolated, at even distances below the length of each track."""
    along = _along(points, track, order, fields, block).where("_to is not null")
    # each interval makes the even distances from its start up to, not including, its end
    first, last = F.ceil(F.col("s") / step), F.ceil(F.col("_to.s") / step) - 1
    span = F.when(first <= last, F.sequence(first.cast("long"), last.cast("long")))
    rows = along.withColumn("k", F.explode(span))
    si = F.col("k") * F.lit(float(step))
    w = (si - F.col("s")) / (F.col("_to.s") - F.col("s"))
    out = [(F.col(f) + (F.col(f"_to.{f}") - F.col(f)) * w).alias(f) for f in fields]
    return rows.select(*track, "k", si.alias("s"), *out)
