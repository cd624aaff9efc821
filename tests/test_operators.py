"""Operators against plain restatements in numpy and Python."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from icegrid.functions import cell_area, parse_tile_name, polar_latlon, polar_xy
from icegrid.operators import filters, ordered, polygons, raster, skew, tiles
from icegrid.operators.components import connected_components, mask_by_component
from icegrid.operators.interp import interp2, lattice
from icegrid.operators.mosaic import feather_weight, mosaic
from icegrid.operators.points import decimate, nan_to_null, union_points


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# order statistics of hot groups


@pytest.mark.parametrize("kind", ["even", "ties", "one value", "outliers"])
def test_hot_group_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(4)
    n = 20000
    values = {
        "even": rng.standard_normal(n),
        "ties": rng.integers(0, 5, n).astype(float),
        "one value": np.full(n, 7.0),
        "outliers": np.where(rng.random(n) < 1e-3, 1e12, rng.random(n)),
    }[kind]
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.7, "hot", "cold"), "v": values})
    pdf.loc[:9, "k"] = None
    df = spark.createDataFrame(pdf)
    probs = {"a": 0.16, "b": 0.5, "c": 0.84}
    got = skew.group_quantiles(df, ["k"], F.col("v"), probs, group_rows=5).collect()
    assert len(got) == 3
    for r in got:
        mine = pdf[pdf.k.isna()] if r["k"] is None else pdf[pdf.k == r["k"]]
        want = np.quantile(mine.v, list(probs.values()))
        assert np.allclose([r["a"], r["b"], r["c"]], want, rtol=1e-12, atol=1e-9)


def test_both_quantile_ways_agree(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"k": rng.integers(0, 30, 3000) ** 2 // 40, "v": rng.standard_normal(3000)})
    df = spark.createDataFrame(pdf)
    a = skew.group_quantiles(df, ["k"], F.col("v"), {"q": 0.3}).toPandas().sort_values("k")
    b = skew.group_quantiles(df, ["k"], F.col("v"), {"q": 0.3}, group_rows=50).toPandas().sort_values("k")
    assert np.allclose(a.q.to_numpy(), b.q.to_numpy())
    assert a.k.tolist() == b.k.tolist()


def test_rank_distinct_crosses_blocks(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.integers(0, 2, 4000), "v": rng.integers(-5000, 5000, 4000).astype(float)})
    got = skew.rank_distinct(spark.createDataFrame(pdf), ["k"], "v", "r", block=64).toPandas()
    for k, g in got.groupby("k"):
        values = np.unique(pdf[pdf.k == k].v)
        assert np.array_equal(g.sort_values("r").v.to_numpy(), values)
        assert np.array_equal(np.sort(g.r.to_numpy()), np.arange(len(values)))


def test_attach_matches_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    table = spark.createDataFrame([(None, 5), (2, 6)], "k int, w int")
    assert rows(skew.attach(df, table, ["k"]), "v") == [(1, "a", None), (None, "b", 5)]
    assert rows(skew.keep(df, table, ["k"]), "v") == [(None, "b")]
    assert rows(skew.leave(df, table, ["k"]), "v") == [(1, "a")]


def test_hot_key_of_a_join_is_split(spark):
    small = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("int")
        rows_ = spark.range(0, 300000, 1, 8).select(key.alias("k"), F.xxhash64("id").alias("h"))
        stats = rows_.groupBy("k").agg(F.count("*").alias("n"))
        out = skew.attach(rows_, stats, ["k"])
        # a grouping by the same key must not undo the split
        total = out.groupBy("k").agg(F.sum("n").alias("s"), F.count("*").alias("c"), F.max("h").alias("h"))
        got = {r.k: (r.s, r.c) for r in total.collect()}
        assert got[7][0] == got[7][1] ** 2 and got[7][1] > 100000
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
        some = skew.keep(rows_, stats.where("n > 5"), ["k"])
        some = some.agg(F.count("*").alias("n"), F.max("h").alias("h"))
        assert some.collect()[0]["n"] == 300000
        assert "skew=true" in some._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_are_numbered_over_parts(spark):
    names = [f"n{(k * 7919) % 5000:05d}" for k in range(5000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(8)
    got = skew.number_rows(df, ["name"], "k").toPandas().sort_values("k")
    assert got.k.tolist() == list(range(1, 5001))
    assert got.name.tolist() == sorted(names)


# projection


def test_projection_known_point_and_round_trip(spark):
    df = spark.createDataFrame([(-75.0, 50.0)], "lat double, lon double")
    x, y = polar_xy(F.col("lat"), F.col("lon"), -1)
    got = df.select(x, y).first()
    assert got[0] == pytest.approx(1255380.79, abs=0.01)
    assert got[1] == pytest.approx(1053389.56, abs=0.01)
    grid = [(float(a), float(b)) for a in range(50, 90, 3) for b in range(-179, 180, 13)]
    for hemi in (1, -1):
        df = spark.createDataFrame([(hemi * a, b) for a, b in grid], "lat double, lon double")
        x, y = polar_xy(F.col("lat"), F.col("lon"), hemi)
        df = df.select("lat", "lon", x.alias("x"), y.alias("y"))
        lat, lon = polar_latlon(F.col("x"), F.col("y"), hemi)
        worst = df.select(F.max(F.abs(lat - F.col("lat"))), F.max(F.abs(lon - F.col("lon")))).first()
        assert max(worst) < 1e-8
    one = spark.range(1).select(cell_area(F.lit(70.0), 1000.0, 1)).first()[0]
    assert one == pytest.approx(1e6, rel=1e-12)
    lats = spark.createDataFrame([(-90.0,), (-89.9999,)], "lat double")
    pole, near = (r[0] for r in lats.orderBy("lat").select(cell_area(F.col("lat"), 1000.0, -1)).collect())
    assert pole == pytest.approx(near, rel=1e-9)


def test_bad_tile_names_are_null(spark):
    df = spark.createDataFrame([("E480_N-1360.h5",), ("/a/E1_N2/E-40_N80.h5",), ("notes.txt",)], "n string")
    x, y = parse_tile_name(F.col("n"))
    assert rows(df.select("n", x.alias("x"), y.alias("y")), "n") == [
        ("/a/E1_N2/E-40_N80.h5", -40000.0, 80000.0), ("E480_N-1360.h5", 480000.0, -1360000.0),
        ("notes.txt", None, None),
    ]


# points


def test_decimation_matches_loop(spark):
    rng = np.random.default_rng(2)
    n = 4000
    pdf = pd.DataFrame({
        "x": rng.uniform(-15000, 15000, n), "y": rng.uniform(-15000, 15000, n),
        "ref_pt": rng.integers(1, 900, n), "rgt": rng.integers(1, 4, n),
        "along_track": rng.random(n) < 0.9, "id": np.arange(n),
    })
    pdf.loc[:1500, ["x", "y"]] = 100.0
    width, sub, target = 30000.0, 5000.0, 3000.0
    got = decimate(spark.createDataFrame(pdf), width, target, sub).toPandas()
    keep = list(pdf.id[~pdf.along_track])
    start = -width / 2 + sub / 2
    at = pdf[pdf.along_track].copy()
    at["b"] = list(zip(np.round((at.x - start) / sub), np.round((at.y - start) / sub)))
    at["g"] = at.ref_pt + 2006500.0 * at.rgt
    for _, g in at.groupby("b"):
        step = len(g) / sub**2 / (target / width**2)
        if step < 1:
            keep += list(g.id)
            continue
        refs = np.unique(g.g)
        pick = np.arange(0, len(refs), step).astype(int)
        keep += list(g.id[g.g.isin(refs[pick[pick < len(refs)]])])
    assert sorted(got.id) == sorted(keep)
    assert len(keep) < n


def test_union_and_missing_values(spark):
    a = spark.createDataFrame([(1.0, 2.0), (float("nan"), 3.0)], "z double, x_atc double")
    b = spark.createDataFrame([(5.0,)], "z double")
    out = union_points(nan_to_null(a), b)
    assert sorted(rows(out, "z"), key=str) == sorted([(None, 3.0), (1.0, 2.0), (5.0, None)], key=str)


def test_known_edits(spark):
    pts = [(741, 7, 0.0, 0.0, 0), (741, 8, 0.0, 0.0, 0), (1092, 1, 470000.0, -1350000.0, 1), (1092, 1, 0.0, 0.0, 2)]
    df = spark.createDataFrame(pts, "rgt int, cycle int, x double, y double, tile int")
    out = filters.apply_edit_list(df, filters.edit_list(spark), ["tile"])
    assert rows(out.select("rgt", "cycle", "tile"), "rgt", "tile") == [(741, 8, 0), (1092, 1, 2)]


def test_a_tile_is_placed_before_its_edits(spark):
    far = [(741, 7, 5e5, 3e6, 0)] * 5
    near = [(1092, 1, 480000.0, -1360000.0, 0)] * 5
    df = spark.createDataFrame(far + near, "rgt int, cycle int, x double, y double, tile int")
    kept = filters.apply_edit_list(df, filters.edit_list(spark), ["tile"])
    # the mean of all ten points is far from the named place, so the placed rule does not hold
    assert {r.rgt for r in kept.collect()} == {1092}
    beside = df.withColumn("y", F.when(F.col("rgt") == 741, -1.3e6).otherwise(F.col("y")))
    assert filters.apply_edit_list(beside, filters.edit_list(spark), ["tile"]).count() == 0


def test_tile_boxes_are_closed(spark):
    df = spark.createDataFrame([(20000.0, 0.0), (9999.0, 0.0), (30000.0, 30000.0)], "x double, y double")
    got = rows(tiles.assign_tiles(df, 6e4, 4e4).select("x", "x0", "y0"), "x", "x0", "y0")
    assert got == [
        (9999.0, 0.0, 0.0), (20000.0, 0.0, 0.0), (20000.0, 40000.0, 0.0), (30000.0, 0.0, 0.0),
        (30000.0, 0.0, 40000.0), (30000.0, 40000.0, 0.0), (30000.0, 40000.0, 40000.0),
    ]


# grids


def grid_frame(spark, values, name="mask"):
    cells = [(x, y, v) for y, line in enumerate(values) for x, v in enumerate(line)]
    return spark.createDataFrame(cells, f"ix int, iy int, {name} int")


def as_array(df, name="mask"):
    pdf = df.toPandas()
    out = np.zeros((pdf.iy.max() - pdf.iy.min() + 1, pdf.ix.max() - pdf.ix.min() + 1), int)
    out[pdf.iy - pdf.iy.min(), pdf.ix - pdf.ix.min()] = pdf[name]
    return out


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_dilation_and_opening_by_hand(spark, n):
    rng = np.random.default_rng(n)
    m = (rng.random((12, 15)) < 0.12).astype(int)
    low, high = -(n - 1 - n // 2), n // 2

    def spread(a, lo, hi, pick, outside):
        out = np.zeros_like(a)
        for y in range(a.shape[0]):
            for x in range(a.shape[1]):
                vals = [
                    a[j, i] if 0 <= j < a.shape[0] and 0 <= i < a.shape[1] else outside
                    for j in range(y + lo, y + hi + 1) for i in range(x + lo, x + hi + 1)
                ]
                out[y, x] = pick(vals)
        return out

    wide = spread(m, low, high, max, 0)
    assert np.array_equal(as_array(raster.dilate(grid_frame(spark, m.tolist()), n, n)), wide)
    opened = spread(spread(wide, -high, -low, min, 0), low, high, max, 0)
    got = raster.open_mask(grid_frame(spark, wide.tolist()), n)
    assert np.array_equal(as_array(got), opened)


@pytest.mark.parametrize("n", [2, 3, 7, 40])
def test_stencils_on_a_table_with_holes(spark, n):
    rng = np.random.default_rng(n)
    cells = [(x - 4, y + 3, int(rng.random() < (0.1 if n < 5 else 0.9)) if rng.random() > 0.05 else None)
             for y in range(14) for x in range(16) if rng.random() > 0.1]
    value = {(x, y): v for x, y, v in cells}
    df = spark.createDataFrame([(*c, k % 2) for c in cells for k in range(2)], "ix int, iy int, mask int, k int")

    def line(v, at, lo, hi, axis):
        return [v.get((at[0] + s, at[1]) if axis == 0 else (at[0], at[1] + s)) for s in range(lo, hi + 1)]

    wide, kept = dict(value), dict(value)
    for axis in (0, 1):
        wide = {c: max((v for v in line(wide, c, -(n - 1 - n // 2), n // 2, axis) if v is not None), default=None)
                for c in wide}
        kept = {c: int(all(line(kept, c, -(n // 2), n - 1 - n // 2, axis))) for c in kept}
    for fn, want in ((raster.dilate, wide), (raster.erode, kept)):
        got = fn(df, n, n, "mask", ["k"])
        assert got.dtypes == df.dtypes
        assert {(r.ix, r.iy): r.mask for r in got.where("k = 1").collect()} == want
        assert got.count() == 2 * len(cells)


def test_gaussian_fill_by_hand(spark):
    rng = np.random.default_rng(3)
    z = rng.random((9, 11))
    z[rng.random(z.shape) < 0.4] = np.nan
    cells = [(x, y, None if np.isnan(v) else float(v)) for (y, x), v in np.ndenumerate(z)]
    df = spark.createDataFrame(cells, "ix int, iy int, v double")
    got = raster.fill_gaps(df, ["v"], 1.0).toPandas().set_index(["iy", "ix"])["v"]
    w = np.exp(-0.5 * np.arange(-4, 5) ** 2)
    for (y, x), v in np.ndenumerate(z):
        if np.isnan(v):
            num = den = 0.0
            for dy in range(-4, 5):
                for dx in range(-4, 5):
                    j, i = y + dy, x + dx
                    if 0 <= j < 9 and 0 <= i < 11 and not np.isnan(z[j, i]):
                        num += w[dy + 4] * w[dx + 4] * z[j, i]
                        den += w[dy + 4] * w[dx + 4]
            v = num / den
        assert got[(y, x)] == pytest.approx(v)


def test_interpolation_needs_only_weighted_corners(spark):
    grid = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0)], "ix int, iy int, v double")
    at = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (5.0, 1.0), (50.0, 0.0)], "x double, y double")
    got = rows(interp2(at, grid, {"v": "v"}, 10.0), "x", "y")
    assert got == [(0.0, 0.0, 1.0), (5.0, 0.0, 2.0), (5.0, 1.0, None), (50.0, 0.0, None)]
    assert lattice(grid, [], 1).count() == 12


def test_polygon_with_hole_and_repeat_rows(spark):
    def ring(pts, p=1):
        return [(p, *a, *b) for a, b in zip(pts, pts[1:] + pts[:1])]

    outer = [(-0.5, -0.5), (6.5, -0.5), (6.5, 6.5), (-0.5, 6.5)]
    hole = [(1.5, 1.5), (4.5, 1.5), (4.5, 4.5), (1.5, 4.5)]
    df = spark.createDataFrame(ring(outer) + ring(hole), "poly_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.ix, r.iy) for r in polygons.rasterize(df, 1.0, ["poly_id"]).collect()}
    want = {(i, j) for i in range(7) for j in range(7)} - {(i, j) for i in (2, 3, 4) for j in (2, 3, 4)}
    assert got == want
    touched = {(r.ix, r.iy) for r in polygons.touched_cells(df.where("y1 = 1.5 and y2 = 1.5"), 1.0, ["poly_id"]).collect()}
    assert touched == {(i, j) for i in range(1, 6) for j in (1, 2)} - {(1, 3)}


def test_asof_is_strictly_before(spark):
    bands = spark.createDataFrame([(t,) for t in (2017.0, 2019.0, 2019.5, 2030.2)], "t double")
    versions = spark.createDataFrame([(t,) for t in (2018.5, 2019.5, 2021.0)], "version_t double")
    assert rows(polygons.asof_before(bands, versions), "t") == [
        (2017.0, 2018.5), (2019.0, 2018.5), (2019.5, 2018.5), (2030.2, 2021.0)]


def brute_components(cells):
    left, parts = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            part.add((x, y))
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in left:
                    left.remove(n)
                    todo.append(n)
        parts.append(frozenset(part))
    return set(parts)


def test_components_by_hand(spark):
    rng = np.random.default_rng(12)
    snake = [(x, y) for y in range(0, 21, 2) for x in range(-20, 20)]
    snake += [(19 if y % 4 == 1 else -20, y) for y in range(1, 20, 2)]
    noise = [(int(x), int(y)) for x, y in rng.integers(30, 60, (600, 2))]
    cells = sorted(set(snake + noise))
    df = spark.createDataFrame(cells, "ix int, iy int")
    got = connected_components(df).toPandas()
    parts = {frozenset(zip(g.ix, g.iy)) for _, g in got.groupby("label")}
    assert parts == brute_components(cells)
    assert len(got) == len(cells)


def test_unsampled_epochs_of_parts(spark):
    data = []
    for it in range(5):
        data += [(0, 0, it, 1.0, 5.0, 3 if it in (1, 3) else 0), (1, 0, it, 2.0, 5.0, 0)]
        data += [(9, 9, it, 3.0, 5.0, 1), (4, 4, it, 4.0, 0.0, 0)]
    df = spark.createDataFrame(data, "ix int, iy int, it int, dz double, cell_area double, count int")
    got = {(r.ix, r.it): r.dz for r in mask_by_component(df).collect()}
    assert [got[(0, k)] for k in range(5)] == [None, 1.0, 1.0, 1.0, None]
    assert [got[(1, k)] for k in range(5)] == [None, 2.0, 2.0, 2.0, None]
    assert all(got[(9, k)] is None for k in range(5))
    assert all(got[(4, k)] == 4.0 for k in range(5))


def test_mosaic_is_smooth_and_skips_missing(spark):
    cells = [(0.0, 0.0, x, 0.0, 1.0) for x in np.arange(-30000.0, 30001.0, 1000.0)]
    cells += [(40000.0, 0.0, x, 0.0, 3.0) for x in np.arange(10000.0, 70001.0, 1000.0)]
    df = spark.createDataFrame([tuple(map(float, c)) for c in cells], "x0 double, y0 double, x double, y double, v double")
    df = df.withColumn("w", F.when(F.col("x") != 5000, F.col("v")))
    out = mosaic(df, ["v", "w"], 60000.0, 5000.0, 10000.0, keys=("x", "y")).orderBy("x").toPandas()
    v = out.set_index("x")["v"]
    assert v[0.0] == 1.0 and v[40000.0] == 3.0 and v[20000.0] == pytest.approx(2.0)
    assert np.abs(np.diff(v)).max() <= 0.21
    assert math.isnan(out.set_index("x")["w"][5000.0])
    edge = df.where("x = -25000").select(feather_weight(60000.0, 5000.0, 10000.0)).first()[0]
    assert edge == 0.0


# tracks


def test_track_length_and_resampling_across_blocks(spark):
    n = 300
    x = np.cumsum(np.linspace(1, 50, n))
    pdf = pd.DataFrame({"t": 1, "k": np.arange(n) * 3, "x": x, "y": 0.5 * x, "v": np.sin(x / 900)})
    df = spark.createDataFrame(pdf)
    s = np.concatenate([[0], np.cumsum(np.hypot(np.diff(x), np.diff(0.5 * x)))])
    got = ordered.arc_length(df, ["t"], "k", block=32).orderBy("k").toPandas()
    assert np.allclose(got.s, s)
    even = ordered.resample_track(df, ["t"], "k", ["x", "v"], 100.0, block=32).orderBy("k").toPandas()
    want = np.arange(0, s[-1], 100)
    assert np.allclose(even.s, want)
    assert np.allclose(even.x, np.interp(want, s, x))
    assert np.allclose(even.v, np.interp(want, s, pdf.v))


def test_rates_need_both_epochs(spark):
    df = spark.createDataFrame([(0, 0, k, k / 4, float(k * k)) for k in (0, 1, 2, 6)], "ix int, iy int, it int, t double, dz double")
    got = rows(ordered.lagged_rate(df, (1, 4)).select("it", "lag", "t", "dzdt"), "it", "lag")
    assert got == [(0, 1, 0.125, 4.0), (1, 1, 0.375, 12.0), (2, 4, 1.0, 32.0)]


def test_curve_lookup_outside_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (1, 3.0, 30.0), (2, 3.0, 1.0), (2, 5.0, 1.0)], "k int, x double, y double")
    got = rows(ordered.interp_at(df, ["k"], "x", {"v": (F.lit(2.0), "y")}), "k")
    assert got == [(1, 20.0), (2, None)]


def test_all_steps_of_preparation_run(spark, sf_dir):
    from checks.tables import grid, pts
    from icegrid.operators.filters import edit_list
    from icegrid.plans.prepare import PointRules, prepare_points

    rules = PointRules(
        sigma_tol=0.2, dem_tol=400.0, geoid_tol=-50.0, edge_pad=1000.0, edit_width=4e4, n_target=500.0,
        min_points=5,
    )
    mask = grid(spark, sf_dir).select("ix", "iy", "mask")
    out = prepare_points(pts(spark, sf_dir), rules, edit_list(spark), mask, 1e4)
    row = out.agg(F.count("*"), F.count("floating"), F.count("editable"), F.count("three_sigma_edit")).first()
    assert row[0] > 0 and len(set(row)) == 1


def test_medians_are_found_where_rows_lie(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), F.col("id"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 101).cast("double")).alias("v"))
    plain = skew.with_group_median(df, ["k"], F.col("v"), "m")
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    split = skew.with_group_median(df, ["k"], F.col("v"), "m", group_rows=20)
    assert rows(plain, "id") == rows(split, "id")
    values = skew.group_median(df, ["k"], F.col("v"), "m")
    assert "REPARTITION_BY_COL" in values._jdf.queryExecution().executedPlan().toString()


def test_tracks_are_ordered_whole_unless_crowded(spark, monkeypatch):
    df = spark.range(200).select(
        (F.col("id") % 3).alias("t"), (F.col("id") * 100).alias("k"), (F.col("id") * 30.0).alias("x"),
        F.lit(0.0).alias("y"), (F.col("id") * 2.0).alias("v"))
    plain = ordered.resample_track(df, ["t"], "k", ["x", "v"], 100.0, block=32)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    monkeypatch.setattr(ordered, "GROUP_ROWS", 5)
    split = ordered.resample_track(df, ["t"], "k", ["x", "v"], 100.0, block=32)
    a, b = (f.orderBy("t", "k").toPandas() for f in (plain, split))
    assert len(a) == len(b) > 100 and np.allclose(a, b)


def test_change_product_takes_more_tasks_for_more_rows(spark, monkeypatch):
    from icegrid.operators import products

    rows = [(i % 9, i // 9, k, 2019.0 + k / 4, float(i * k), 0.5, 1e6 * (i % 3), 2.0, 1.0, 1.0)
            for i in range(60) for k in range(6)]
    dz = spark.createDataFrame(rows, "ix int, iy int, it int, t double, dz double, sigma_dz double, cell_area double, "
                                     "count double, misfit_rms double, misfit_scaled_rms double")

    def made():
        out = products.change_product(dz, 1e4, lags=(1, 4), scales=(20000,))
        plan = out._jdf.queryExecution().executedPlan().toString()
        return plan, sorted(map(str, out.collect()))

    _, whole = made()
    monkeypatch.setattr(products, "TASK_ROWS", 9)
    plan, dealt = made()
    # 360 rows in shares of 9; the windows along a cell take the cells as they were dealt
    assert "hashpartitioning(ix" in plan and ", 40)" in plan
    assert dealt == whole
