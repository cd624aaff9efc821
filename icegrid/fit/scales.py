"""Search for the smoothness that makes the residuals of a track agree with their errors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icegrid.fit.design import FitSpec
from icegrid.fit.solve import TileSystem
from icegrid.operators.ordered import interp_at, track_segments
from icegrid.operators.skew import TOLD_KEYS, attach
from icegrid.session import by_group, cut_lineage, stored

# Factors tried, expected curvature, gap length, node spacing and strip width.
SCALES = (0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0, 30.0, 100.0, 300.0)
E_CURVATURE = 0.006
GAP_SCALE = 2500.0
SPACING = 50.0
STRIP = 200.0

TRACK = ["rgt", "pair"]
PLACE = [*TRACK, "seg", "pt0"]


# Least number of points that a segment keeps.
FEWEST = 3


def strip_spec(length: float) -> FitSpec:
    """A fit of one segment: a strip of two rows of nodes that stands for STRIP metres across.

    Both rows see the points alike, so they are equal, and the strip is a profile. There is no
    change in time.
    """
    share = float(np.sqrt(SPACING / STRIP))
    return FitSpec(
        width=float(np.ceil(length / SPACING) * SPACING), height=SPACING, z0_spacing=SPACING,
        dz_spacing=SPACING, dt=1.0, t_start=0.0, n_epochs=2, ref_epoch=0,
        e_d2z0_dx2=E_CURVATURE * share, e_dz0_dx=E_CURVATURE * GAP_SCALE * share,
    )


def segment_members(points: DataFrame, width: float, min_fill: float) -> DataFrame:
    """Points of the chosen cycle of each segment, one per reference point, under PLACE.

    The averaged points and the chosen cycles are stored. Points meet the cycles before they are
    moved, unless the segments are too many to be told to all tasks. Runs jobs.
    """
    dn = int(np.ceil(width / 20))
    good = points.where("z is not null and sigma > 0")
    where = [c for c in ("x", "y") if c in points.columns]
    nodes = good.groupBy(*TRACK, "cycle", "ref_pt").agg(
        *[F.avg(c).alias(c) for c in ("x_atc", "z", "sigma", *where)]
    )
    nodes = stored(nodes, "nodes")
    chosen = cut_lineage(track_segments(nodes, dn, TRACK, min_fill).select(*PLACE, "cycle"))
    if chosen.count() <= TOLD_KEYS:
        chosen = F.broadcast(chosen)
    # members of a segment lie within 1.5 dn of its centre; those of the chosen cycle are fitted
    half = dn / 2
    first = nodes.groupBy(*TRACK).agg(F.min("ref_pt").alias("_p0"))
    spot = (F.col("ref_pt") - F.col("_p0") - half) / half
    spread = F.sequence(
        F.greatest(F.floor(spot - 3) + 1, F.lit(0)).cast("int"), (F.ceil(spot + 3) - 1).cast("int")
    )
    member = attach(nodes, first, TRACK).where(F.ceil(spot + 3) - 1 >= 0)
    member = member.withColumn("seg", F.explode(spread)).drop("_p0")
    return member.join(chosen, [*TRACK, "seg", "cycle"])


def strip_limits(spec: FitSpec) -> tuple[np.ndarray, np.ndarray, float]:
    """The constraints of a strip whose two rows of nodes are equal and that does not change.

    Returns their part of the system of the row, the diagonal of the whole system at the nodes of
    a row, and its largest entry at the other nodes, which no point or factor of a strip touches.
    """
    bare = TileSystem(pd.DataFrame({"a": [], "b": [], "v": []}, dtype=float), spec)
    n = spec.shape(spec.z0_spacing)[0]
    rough = np.zeros((n, n))
    for index, c in bare.blocks:
        rows = np.zeros((len(index), n))
        np.add.at(rows, (np.arange(len(index))[:, None], index % n), c * (index < spec.n_z0))
        rough += rows.T @ rows
    own = bare.diagonal() - bare.ridge
    return rough, own[:n], own[spec.n_z0:].max()


def strip_fits(
    place: np.ndarray, z: np.ndarray, sigma: np.ndarray, factors: np.ndarray, spec: FitSpec, limits,
    max_iterations: int, converged: float = 0.001,
) -> tuple[np.ndarray, np.ndarray]:
    """The robust fit (as robust_fit) of the points of one strip, once for each factor on its limits.

    place is along the strip, from its middle. Returns, with one row per factor, the scaled
    residuals of the last fit and the points it was made with. Factors that are done are not
    fitted again.
    """
    rough, own, other = limits
    n = len(rough)
    at = (place + spec.width / 2) / spec.z0_spacing
    # the far edge belongs to the last cell
    low = np.minimum(np.floor(at), n - 2).astype(int)
    design = np.zeros((len(at), n))
    rows = np.arange(len(at))
    design[rows, low], design[rows, low + 1] = 1 - (at - low), at - low
    soft = 1 / factors**2
    used = np.ones((len(factors), len(at)), bool)
    rs = np.zeros(used.shape)
    going = np.arange(len(factors))
    for step in range(max_iterations):
        w = used[going] / sigma**2
        system = (design.T * w[:, None, :]) @ design
        spot = np.arange(n)
        # a point lies halfway between the two rows; the ridge is that of TileSystem
        largest = (system[:, spot, spot] / 4 + own * soft[going, None]).max(1)
        ridge = 1e-12 * np.maximum(largest, other)
        system += rough * soft[going, None, None]
        system[:, spot, spot] += 2 * ridge[:, None]
        g = (w * z) @ design
        m = np.zeros(g.shape)
        known = g.any(1)
        if known.any():
            m[known] = np.linalg.solve(system[known], g[known, :, None])[:, :, 0]
        rs[going] = (z - m @ design.T) / sigma
        if step == max_iterations - 1:
            break
        still = []
        for k in going:
            good = np.abs(rs[k]) < 3 * max(half_spread(rs[k][used[k]]), 1.0)
            if (good != used[k]).mean() >= converged:
                used[k] = good
                still.append(k)
        going = np.array(still, int)
        if not still:
            break
    return rs, used


def half_spread(v: np.ndarray) -> float:
    """As robust_spread: half the distance between the 16th and 84th percentile, 0 of nothing."""
    low, high = np.percentile(v, [16, 84]) if len(v) else (0.0, 0.0)
    return (high - low) / 2


CURVE = ("rgt {rgt}, pair {pair}, seg {seg}, pt0 {pt0}, scale double, expected double, spread double, "
         "n int, kept double, mean_x double, mean_y double, mean_z double")


def l_curve(
    points: DataFrame, width: float, scales: tuple[float, ...] = SCALES, min_fill: float = 0.9,
    max_iterations: int = 5,
) -> DataFrame:
    """Residual spread of each track segment for each factor on the expected curvature.

    points holds rgt, pair, ref_pt, cycle, x_atc, z, sigma and may hold x and y. Measurements at
    one reference point and cycle are averaged, so a segment has at most three segment lengths of
    points. Returns, under PLACE and scale, the expected curvature, the spread of the scaled
    residuals of the points kept, their number n, the share kept, and the mean x, y and z of the
    segment (NULL without x and y).

    The points of a segment come to one task, where all factors are fitted and edited together,
    so nothing is shuffled between passes and no point once for each factor. Points must lie within 1.5 widths of
    the middle of their segment, or the query fails.
    """
    member = segment_members(points, width, min_fill)
    for c in ("x", "y"):
        if c not in member.columns:
            member = member.withColumn(c, F.lit(None).cast("double"))
    spec = strip_spec(3 * width + 4 * SPACING)
    limits = strip_limits(spec)
    factors = np.array([float(k) for k in scales])

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x, z, sigma = (pdf[c].to_numpy(float) for c in ("x_atc", "z", "sigma"))
        off = x - (x.min() + x.max()) / 2
        if not (np.abs(off) <= spec.width / 2).all():
            raise ValueError("a point lies outside its segment")
        tried = factors if len(z) >= FEWEST else factors[:0]
        rs, used = strip_fits(off, z, sigma, tried, spec, limits, max_iterations)
        n = used.sum(1)
        spread = [half_spread(r[u]) if u.any() else None for r, u in zip(rs, used)]
        head = dict(zip(PLACE, key))
        mean = {f"mean_{c}": pdf[c].to_numpy(float) for c in ("x", "y", "z")}
        mean = {c: v[~np.isnan(v)].mean() if not np.isnan(v).all() else None for c, v in mean.items()}
        out = pd.DataFrame({"scale": tried, "expected": E_CURVATURE * tried,
                            "spread": pd.Series(spread, dtype=float),
                            "n": pd.Series(n).where(n > 0).astype("Int32"),
                            "kept": pd.Series(n / max(len(z), 1)).where(n > 0)})
        return out.assign(**head, **mean)[[*PLACE, *out.columns, *mean]]

    member = by_group(member.select(*PLACE, "x_atc", "z", "sigma", "x", "y"), PLACE)
    return member.groupBy(*PLACE).applyInPandas(one, CURVE.format(**dict(member.dtypes)))


def best_scale(curve: DataFrame) -> DataFrame:
    """Expected curvature at which the spread is one, and at 1.1 times its minimum."""
    usable = curve.where("spread > 0 and n > 0")
    # a segment has one row per factor
    least = F.min("spread").over(Window.partitionBy(*PLACE))
    rows = usable.withColumn("spread_min", least)
    keys = [*PLACE, *[c for c in ("mean_x", "mean_y", "mean_z") if c in curve.columns], "spread_min"]
    return interp_at(rows, keys, "spread", {
        "e_for_spread_1": (F.lit(1.0), "expected"),
        "n_at_spread_1": (F.lit(1.0), "n"),
        "kept_at_spread_1": (F.lit(1.0), "kept"),
        "e_10pct_above_min": (1.1 * F.col("spread_min"), "expected"),
    }, loglog=True)
