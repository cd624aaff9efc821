"""The fit against analytic cases."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from icegrid.fit import scales, solve
from icegrid.fit import (
    FitSpec, bias_groups, design_rows, edge_priors, evaluate, fit_errors, normal_equations,
    robust_fit, sigma_extra, solution_tables,
)
from icegrid.fit.design import average_z0, constraint_scale, node_mask
from icegrid.fit.errors import upsample_errors
from icegrid.fit.scales import best_scale, l_curve
from icegrid.fit.solve import TileSystem, fit_once, system_rows
from icegrid.operators.tiles import neighbour_tiles

GAP = 2500.0
SPEC = FitSpec(
    width=1e4, height=200.0, z0_spacing=100.0, dz_spacing=200.0, dt=0.5, t_start=-1.0, n_epochs=5,
    ref_epoch=2, e_d2z0_dx2=0.06, e_dz0_dx=0.06 * GAP, e_d3z_dx2dt=1e-4, e_d2z_dxdt=1e-4 * GAP,
    e_d2z_dt2=5000.0,
)
X = np.arange(-5000, 5001, 100.0)


def frame(spark, *parts):
    pdf = pd.concat(parts, ignore_index=True)
    return spark.createDataFrame(pdf.assign(x0=0.0, y0=0.0))


def part(z, t, sigma=1.0, x=X, **extra):
    return pd.DataFrame({"x": x, "y": 0.0, "z": z, "time": float(t), "sigma": sigma, **extra})


def sine(x=X):
    return -100 * np.cos(2 * np.pi * x / 2000)


def z0_line(tables):
    z0 = tables["z0"].where("j = 1").orderBy("x").toPandas()
    return z0["x"].to_numpy(), z0["z0"].to_numpy()


@pytest.mark.parametrize("expected", [0.006, 0.001, 0.0003])
def test_sine_amplitude(spark, expected):
    spec = replace(SPEC, z0_spacing=50.0, e_d2z0_dx2=expected, e_dz0_dx=expected * 1e9)
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    rho = 2 * len(X) / (spec.width * spec.height)
    k4 = 16 * np.pi**4 / 2000**4
    want = 100 / (1 + k4 / (expected**2 * rho))
    x, z0 = z0_line(solution_tables(fit_once(data, spec), spec))
    got = np.abs(z0[np.abs(x) < 3000]).max()
    assert got == pytest.approx(want, rel=0.06)


def test_smaller_gap_scale_is_flatter(spark):
    keep = np.abs(X) > 1500
    data = frame(spark, part(sine()[keep], -0.5, x=X[keep]), part(sine()[keep], 0.5, x=X[keep]))
    ranges = []
    for scale in (4000.0, 250.0):
        spec = replace(SPEC, e_d2z0_dx2=0.006, e_dz0_dx=0.006 * scale)
        x, z0 = z0_line(solution_tables(fit_once(data, spec), spec))
        ranges.append(np.ptp(z0[np.abs(x) < 1000]))
    assert ranges[1] < ranges[0]


TIME = replace(SPEC, e_d2z0_dx2=0.03, e_dz0_dx=0.03 * GAP, e_d3z_dx2dt=0.006, e_d2z_dxdt=0.006 * GAP)


def change_parts():
    return part(0 * X, -0.99), part(100 + sine(), 0.99)


def test_reference_epoch_is_midway(spark):
    data = frame(spark, *change_parts())
    tables = solution_tables(fit_once(data, TIME), TIME)
    x, z0 = z0_line(tables)
    inner = np.abs(x) < 3000
    assert np.abs(z0 - (100 + sine(x)) / 2)[inner].max() < 15
    assert tables["dz"].where("it = 2 and dz <> 0").isEmpty()
    assert tables["dz"].select("it").distinct().count() == TIME.n_epochs


def test_outliers_are_edited(spark):
    rng = np.random.default_rng(532)
    parts = pd.concat(change_parts(), ignore_index=True)
    parts["z"] += rng.standard_normal(len(parts))
    bad = rng.random(len(parts)) > 0.90
    shift = (rng.random(len(parts)) - 0.5) * 200
    parts["bad"] = bad & (np.abs(shift) > 20)
    parts.loc[bad, "z"] += shift[bad]
    parts["editable"] = True
    spec = replace(TIME, dz_spacing=100.0, height=200.0)
    fit = robust_fit(frame(spark, parts), spec, max_iterations=10)
    data = fit["data"].toPandas()
    assert len(data) == len(parts)
    flagged = ~data["three_sigma_edit"]
    assert flagged[data["bad"]].mean() > 0.8
    assert flagged[~data["bad"]].mean() < 0.2


def test_points_not_editable_stay(spark):
    parts = pd.concat([part(0 * X, -0.5), part(0 * X, 0.5)], ignore_index=True)
    parts["z"] = np.where(parts.index % 20 == 0, 500.0, 0.0)
    parts["editable"] = False
    fit = robust_fit(frame(spark, parts), SPEC, max_iterations=3)
    assert fit["data"].where("not three_sigma_edit").isEmpty()


def test_bias_makes_a_smoother_series(spark):
    rng = np.random.default_rng(1)
    times = np.linspace(-0.99, 0.99, 9)
    shifts = rng.standard_normal(9) * 0.25
    parts = [
        part(0.5 * t + b + rng.standard_normal(len(X)) * 0.1, t, 0.1, cycle=k, sigma_corr=0.25)
        for k, (t, b) in enumerate(zip(times, shifts))
    ]
    data = frame(spark, *parts)
    rough = []
    for params in ((), ("cycle",)):
        spec = replace(TIME, dt=0.25, n_epochs=9, ref_epoch=4, bias_params=params, e_d2z_dt2=2.0)
        biases = bias_groups(data, params) if params else None
        tables = solution_tables(fit_once(data, spec, biases), spec)
        series = tables["dz"].where("i = 25 and j = 0").orderBy("it").toPandas()["dz"].to_numpy()
        rough.append(np.abs(np.diff(series, 2)).mean())
        if params:
            assert tables["bias"].count() == 9
            assert biases.select("expected").distinct().collect() == [(0.25,)]
    assert rough[1] < rough[0]


def test_errors_grow_in_a_gap_and_coarse_errors_agree(spark):
    spec = replace(TIME, z0_spacing=100.0, dz_spacing=200.0, height=400.0)
    keep = np.abs(X) > 1000
    data = frame(spark, part(0 * X[keep], -0.99, x=X[keep]), part(0 * X[keep], 0.99, x=X[keep]))
    fine = fit_errors(system_rows(data, spec), spec, lags=(1, 2), scales=(1000,))
    z0 = fine.where("field = 'z0' and j = 2").orderBy("i").toPandas()["sigma"].to_numpy()
    assert z0[50] > 1.5 * z0[20]
    assert z0[0] > z0[20]
    assert fine.where("field = 'dz' and scale_m = 0 and it = 2 and sigma > 0").isEmpty()
    one = fine.where("field = 'dz' and scale_m = 0 and lag = 0").agg(F.avg("sigma")).first()[0]
    mean = fine.where("field = 'dz' and scale_m = 1000 and lag = 0").agg(F.avg("sigma")).first()[0]
    assert mean <= one
    coarse_spec = spec.coarser(2, 1)
    coarse = fit_errors(system_rows(data, coarse_spec), coarse_spec)
    up = upsample_errors(coarse.where("field = 'z0'"), ["x0", "y0"], 2)
    up = up.where("j = 2").orderBy("i").toPandas()["sigma"].to_numpy()
    assert np.abs(up - z0)[10:90].max() / z0.max() < 0.35


@pytest.mark.parametrize("params", [(), ("cycle",)])
def test_errors_equal_the_inverse_of_the_whole_matrix(spark, params):
    spec = replace(TIME, z0_spacing=100.0, dz_spacing=200.0, height=400.0, bias_params=params)
    data = frame(spark, *change_parts()).withColumns({
        "cycle": F.rint(F.col("time") * 2).cast("int") + 10_005, "sigma_corr": F.lit(0.2)})
    rows = system_rows(data, spec, bias_groups(data, params) if params else None)
    got = fit_errors(rows, spec, lags=(1, 2), scales=(600,)).toPandas()
    system = TileSystem(rows.toPandas(), spec)
    cov = np.linalg.inv(system.dense())
    at = {int(n): k for k, n in enumerate(system.nodes)}
    nx, ny = spec.shape(spec.dz_spacing)
    for r in got.itertuples():
        c = np.zeros(system.n)
        if r.field in ("z0", "bias"):
            c[at[r.node]] = 1.0
        else:
            per = max(1, round(r.scale_m / spec.dz_spacing))
            cells = [(j, i) for j in range(r.j * per, min((r.j + 1) * per, ny))
                     for i in range(r.i * per, min((r.i + 1) * per, nx))]
            for j, i in cells:
                for it, sign in ((r.it + r.lag, 1), (r.it, -1))[: 1 + (r.lag > 0)]:
                    node = spec.n_z0 + (it * ny + j) * nx + i
                    if node in at:
                        c[at[node]] += sign / len(cells) / (r.lag * spec.dt or 1)
        assert r.sigma == pytest.approx(np.sqrt(max(c @ cov @ c, 0)), rel=1e-4, abs=1e-6)
    assert (got["field"] == "bias").any() == bool(params)


def test_an_unfinished_solution_is_refused(spark, monkeypatch):
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    system = TileSystem(system_rows(data, SPEC).toPandas(), SPEC)
    monkeypatch.setattr("icegrid.fit.solve.DENSE_NODES", 1)
    with pytest.raises(RuntimeError, match="after 3 rounds"):
        system.solve(max_rounds=3)


def test_bias_numbers_do_not_clash(spark):
    from icegrid.fit.design import bias_key

    df = spark.createDataFrame([(1, 10001, 0, 0), (2, 1, 0, 0), (1387, 4095, 3, 1)], "a long, b long, c long, d long")
    for params in (("a", "b"), ("a", "b", "c"), ("b", "a", "d", "c")):
        if params[0] == "a":
            assert df.select(bias_key(params)).distinct().count() == 3
    assert df.where("b < 4096").select(bias_key(("a", "b", "c", "d"))).distinct().count() == 2
    with pytest.raises(Exception, match="cannot number a bias"):
        df.select(bias_key(("a", "b", "c", "d"))).collect()


def test_large_systems_agree_with_direct_ones(spark, monkeypatch):
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    pdf = system_rows(data, SPEC).toPandas()
    system = TileSystem(pdf, SPEC)
    direct, misfit = system.solve()
    assert misfit < 1e-5
    monkeypatch.setattr("icegrid.fit.solve.DENSE_NODES", 1)
    steps, misfit = system.solve(tol=1e-10, max_rounds=100000)
    assert misfit <= 1e-9
    assert np.abs(steps - direct).max() < 0.05


def test_normal_equations_match_the_points(spark):
    rng = np.random.default_rng(3)
    parts = part(rng.standard_normal(len(X)), 0.3, rng.uniform(0.5, 2, len(X)))
    parts["y"] = rng.uniform(-100, 100, len(X))
    parts["k"] = np.arange(len(X))
    data = frame(spark, parts)
    rows = design_rows(data, SPEC, ["k", "z", "sigma"]).toPandas()
    assert np.allclose(rows[rows.node < SPEC.n_z0].groupby("k")["c"].sum(), 1)
    wide = rows.pivot_table(index="k", columns="node", values="c", fill_value=0.0)
    w = 1 / parts["sigma"].to_numpy()[wide.index] ** 2
    full = wide.to_numpy().T @ (wide.to_numpy() * w[:, None])
    eq = normal_equations(data, SPEC).toPandas()
    at = {n: i for i, n in enumerate(wide.columns)}
    for a, b, v in eq[eq.b >= 0][["a", "b", "v"]].to_numpy():
        assert full[at[int(a)], at[int(b)]] == pytest.approx(v, rel=1e-9)
    assert len(eq[eq.b >= 0]) == np.count_nonzero(np.triu(full))


def test_simulated_surface_is_recovered(spark):
    rng = np.random.default_rng(5)
    n = 15000
    x, y, t = rng.uniform(-1e4, 1e4, n), rng.uniform(-1e4, 1e4, n), rng.uniform(0, 2, n)

    def truth(x, y, t):
        bump = np.exp(-((x - 2000) ** 2 + y**2) / 2 / 2500**2)
        return 2 * np.sin(2 * np.pi * y / 9000) + bump * (1 + 2 * t)

    pdf = pd.DataFrame({"x": x, "y": y, "time": t, "sigma": 0.1})
    pdf["z"] = truth(x, y, t) + 0.1 * rng.standard_normal(n)
    spec = FitSpec(
        width=2e4, z0_spacing=1000.0, dz_spacing=2000.0, dt=0.5, t_start=0.0, n_epochs=5, ref_epoch=2,
        e_d2z0_dx2=0.02, e_d3z_dx2dt=1e-3, e_d2z_dt2=5000.0,
    )
    data = frame(spark, pdf)
    tables = solution_tables(fit_once(data, spec), spec)
    out = evaluate(data, tables, spec).toPandas()
    inner = (np.abs(out.x) < 9000) & (np.abs(out.y) < 9000)
    off = np.sqrt(np.mean((out.z_est - truth(out.x, out.y, out.time))[inner] ** 2))
    assert off < 0.12


def test_priors_pull_the_edges_together(spark):
    spec = replace(
        SPEC, width=6000.0, height=6000.0, z0_spacing=1000.0, dz_spacing=3000.0, n_epochs=3,
        dt=1.0, ref_epoch=1,
    )
    rng = np.random.default_rng(7)
    pdf = pd.concat([
        pd.DataFrame({
            "x": rng.uniform(c - 3000, c + 3000, 400), "y": rng.uniform(-3000, 3000, 400),
            "time": rng.uniform(-1, 1, 400), "sigma": 1.0, "z": h, "x0": c, "y0": 0.0,
        }) for c, h in ((0.0, 0.0), (4000.0, 10.0))
    ])
    data = spark.createDataFrame(pdf)
    tables = solution_tables(fit_once(data, spec), spec)
    tables = {
        "z0": tables["z0"].withColumn("sigma_z0", F.lit(0.01)),
        "dz": tables["dz"].withColumn("sigma_dz", F.lit(0.01)),
    }
    near = neighbour_tiles(data.select("x0", "y0").distinct(), 4000.0)
    priors = edge_priors(near, tables, spec, 4000.0, include=1000.0)
    matched = solution_tables(fit_once(data, spec, priors=priors), spec)["z0"]
    at = F.col("x") == 3000
    before = tables["z0"].where(at & (F.col("x0") == 0)).agg(F.avg("z0")).first()[0]
    after = matched.where(at & (F.col("x0") == 0)).agg(F.avg("z0")).first()[0]
    assert abs(before) < 2 and after > 5


def test_mask_relaxes_constraints(spark):
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    tiles = data.select("x0", "y0").distinct()
    cells = [(i, j, int(i < 0)) for i in range(-12, 13) for j in range(-2, 3)]
    mask = spark.createDataFrame(cells, "ix int, iy int, mask int")
    factors = node_mask(tiles, mask, SPEC, 500.0)
    assert set(r[0] for r in factors.select("factor").distinct().collect()) == {1.0, 10.0}
    spec = replace(SPEC, e_d2z0_dx2=0.0003, e_dz0_dx=None)
    x, z0 = z0_line(solution_tables(fit_once(data, spec, factors=factors), spec))
    off = np.abs(z0[(x > 1000) & (x < 4000)]).max()
    on = np.abs(z0[(x > -4000) & (x < -1000)]).max()
    assert off > 1.5 * on
    scale = constraint_scale(tiles, mask.withColumn("v", F.col("ix") + 0.0), SPEC, 500.0)
    got = {(r["i"], r["j"]): r["scale"] for r in scale.collect()}
    assert got[(0, 0)] == pytest.approx(-10.0) and got[(50, 0)] == pytest.approx(10.0)
    means = average_z0(solution_tables(fit_once(data, SPEC), SPEC)["z0"], SPEC)
    assert means.count() == 51 * 2


def test_extra_error(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x": rng.uniform(-4000, 4000, 4000), "y": 0.0, "sigma": 0.5})
    pdf["r"] = rng.standard_normal(len(pdf)) * 1.3
    got = sigma_extra(spark.createDataFrame(pdf)).collect()
    assert [round(r["sigma_extra"], 0) for r in got] == [1.0]
    assert got[0]["sigma_extra"] == pytest.approx(1.2, abs=0.1)
    pdf["r"] *= 10
    assert sigma_extra(spark.createDataFrame(pdf)).first()["sigma_extra"] == 3.0


def plain_profile(x, z, sigma, expected, width, rounds=5):
    """Spread and number kept of a smooth profile as wide as a strip, edited at three spreads."""
    n = round(width / scales.SPACING) + 1
    u = (x - (x.min() + x.max()) / 2 + width / 2) / scales.SPACING
    i = np.minimum(np.floor(u).astype(int), n - 2)
    rows = np.zeros((len(x), n))
    rows[np.arange(len(x)), i], rows[np.arange(len(x)), i + 1] = 1 - (u - i), u - i
    bend = np.diff(np.eye(n), 2, axis=0) / scales.SPACING**2
    tilt = np.diff(np.eye(n), axis=0) / scales.SPACING / scales.GAP_SCALE
    rough = (bend.T @ bend + tilt.T @ tilt) * scales.SPACING * scales.STRIP / expected**2
    kept = np.ones(len(x), bool)
    for step in range(rounds):
        a = rows[kept] / sigma[kept, None]
        m = np.linalg.solve(a.T @ a + rough + 1e-12 * np.eye(n), a.T @ (z[kept] / sigma[kept]))
        r = (z - rows @ m) / sigma
        low, high = np.percentile(r[kept], [16, 84])
        spread = (high - low) / 2
        new = np.abs(r) < 3 * max(spread, 1.0)
        if step == rounds - 1 or (new != kept).mean() < 0.001:
            return spread, kept.sum()
        kept = new


def test_scale_search_equals_plain_profiles(spark):
    rng = np.random.default_rng(12)
    ref = np.arange(0, 300)
    x = ref * 20.0
    z = 20 * np.sin(2 * np.pi * x / 1500) + 0.2 * rng.standard_normal(len(x))
    z[::17] += 30
    pdf = pd.DataFrame({"rgt": 1, "pair": 1, "ref_pt": ref, "cycle": 3, "x_atc": x, "z": z, "sigma": 0.2,
                        "x": x / 2, "y": -x})
    data = spark.createDataFrame(pdf)
    curve = l_curve(data, 2000.0, scales=(0.1, 1.0, 100.0)).toPandas()
    member = scales.segment_members(data, 2000.0, 0.9).toPandas()
    assert set(curve["scale"]) == {0.1, 1.0, 100.0} and len(curve) == 3 * member["seg"].nunique()
    for _, c in curve.iterrows():
        m = member[member["seg"] == c["seg"]].sort_values("x_atc")
        spread, n = plain_profile(*(m[k].to_numpy() for k in ("x_atc", "z", "sigma")), c["expected"],
                                  scales.strip_spec(3 * 2000.0 + 4 * scales.SPACING).width)
        assert c["spread"] == pytest.approx(spread, rel=1e-4) and c["n"] == n
        assert c["kept"] == pytest.approx(c["n"] / len(m))
        assert c["mean_x"] == pytest.approx(m["x"].mean()) and c["mean_y"] == pytest.approx(m["y"].mean())


def test_scale_search_fits_segments_where_their_points_lie(spark):
    ref = np.arange(0, 400)
    pdf = pd.DataFrame({"rgt": 1, "pair": 1, "ref_pt": ref, "cycle": 3, "x_atc": ref * 20.0,
                        "z": np.sin(ref / 9.0), "sigma": 0.2})
    plan = l_curve(spark.createDataFrame(pdf), 2000.0)._jdf.queryExecution().executedPlan().toString()
    # no pass is a job of its own, no point is shuffled once for each factor, no tiles are numbered
    assert plan.count("FlatMapGroupsInPandas") == 1
    assert "posexplode" not in plan and "ExistingRDD" not in plan.replace("Scan ExistingRDD[rgt", "")


def test_points_are_moved_before_they_are_spread_to_segments(spark, monkeypatch):
    from icegrid.operators import ordered

    ref = np.arange(0, 400)
    pdf = pd.concat([pd.DataFrame({"rgt": 1, "pair": 1, "ref_pt": ref, "cycle": c, "x_atc": ref * 20.0,
                                   "z": np.sin(ref * c / 9.0), "sigma": 0.2}) for c in (1, 2)])
    pdf.loc[pdf["ref_pt"] == 3, "z"] = np.nan
    data = spark.createDataFrame(pdf).replace(float("nan"), None)
    found = ordered.track_segments(data, 100)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(k for k, line in enumerate(lines) if "Generate explode" in line)
    over = [line for line in lines[:at] if "Exchange" in line]
    # above the spread points are only the statistics of their segments
    assert len(over) <= 2 and not any("cycle" in line for line in over)
    member = scales.segment_members(data, 2000.0, 0.9)
    plan = member._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    whole = [sorted(map(str, df.collect())) for df in (found, member)]
    monkeypatch.setattr(ordered, "GROUP_ROWS", 5)
    monkeypatch.setattr(scales, "TOLD_KEYS", 0)
    split = (ordered.track_segments(data, 100), scales.segment_members(data, 2000.0, 0.9))
    assert whole == [sorted(map(str, df.collect())) for df in split] and all(whole)


def test_strip_fits_equal_the_robust_fit_of_a_strip(spark):
    rng = np.random.default_rng(21)
    n, tried = 90, np.array([0.01, 1.0, 300.0])
    spec = scales.strip_spec(2000.0)
    place, sigma = np.sort(rng.uniform(-1000, 1000, n)), rng.choice([0.1, 0.3], n)
    z = 5 * np.sin(place / 300) + sigma * rng.standard_normal(n)
    z[::13] += 40
    step = 2 * spec.width
    data = pd.concat([pd.DataFrame({"x0": 0.0, "y0": k * step, "x": place, "y": k * step, "time": 0.0,
                                    "z": z, "sigma": sigma, "p": range(n)}) for k in range(len(tried))])
    factors = spark.createDataFrame(
        [(0.0, k * step, i, float(f)) for k, f in enumerate(tried) for i in range(spec.n_z0)],
        "x0 double, y0 double, node long, factor double")
    fit = robust_fit(spark.createDataFrame(data), spec, 5, factors=factors)["data"].toPandas()
    rs, used = scales.strip_fits(place, z, sigma, tried, spec, scales.strip_limits(spec), 5)
    assert 0 < used.sum() < used.size
    for k in range(len(tried)):
        one = fit[fit["y0"] == k * step].sort_values("p")
        assert (one["three_sigma_edit"].to_numpy() == used[k]).all()
        assert np.abs((one["z"] - one["z_est"]) / one["sigma"] - rs[k]).max() < 1e-4
    # one more pass starts from no points: a fit of nothing is zero
    lost = scales.strip_fits(place[:10], np.full(10, 9.0), np.full(10, 0.1), tried, spec,
                             scales.strip_limits(spec), 5)
    assert np.abs(lost[0]).max() < 1e-2


def test_nested_lattices_solve_as_the_direct_solver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    spec = FitSpec(width=4e3, z0_spacing=100, dz_spacing=500, dt=0.5, t_start=2019.0, n_epochs=5,
                   ref_epoch=2, bias_params=("cycle",))
    n = 6000
    pdf = pd.DataFrame({"x0": 0.0, "y0": 0.0, "cycle": rng.integers(0, 4, n), "sigma": 0.1,
                        "x": rng.uniform(-2000, 2000, n), "y": rng.choice(np.linspace(-1800, 1800, 9), n),
                        "time": rng.uniform(2019, 2021, n), "sigma_corr": 0.3})
    pdf["z"] = 30 * np.sin(pdf["x"] / 900) + 2 * (pdf["time"] - 2020) + 0.1 * rng.standard_normal(n)
    points = spark.createDataFrame(pdf).withColumn("cycle", F.col("cycle").cast("int"))
    factors = spark.createDataFrame([(0.0, 0.0, k, 10.0) for k in range(300)],
                                    "x0 double, y0 double, node long, factor double")
    rows = system_rows(points, spec, bias_groups(points, spec.bias_params), factors).toPandas()
    system = solve.TileSystem(rows, spec)
    direct, _ = system.solve()
    monkeypatch.setattr(solve, "DENSE_NODES", 10)
    nested, misfit = system.solve()
    assert misfit <= 1e-9 and np.abs(nested - direct).max() < 1e-3 * np.abs(direct).max()
    guide = solve.Nested(system, spec)
    a, b = rng.standard_normal((2, system.n))
    assert a @ guide(b) == pytest.approx(b @ guide(a), rel=1e-4) and a @ guide(a) > 0
    rounds = system.rounds
    system.start = nested
    assert np.abs(system.solve()[0] - nested).max() < 1e-6 * np.abs(nested).max() and system.rounds < rounds / 4
    monkeypatch.setattr(solve, "Nested", lambda s, _: lambda r: r / np.where(s.diagonal() > 0, s.diagonal(), 1))
    system.start = 0 * nested
    system.solve()
    assert rounds < system.rounds / 2


def test_tiles_that_are_done_are_not_fitted_again(spark):
    rng = np.random.default_rng(5)
    spec = FitSpec(width=2e3, z0_spacing=500, dz_spacing=1000, dt=1.0, t_start=2019.0, n_epochs=2, ref_epoch=0)
    pdf = pd.DataFrame({"x0": np.repeat([0.0, 4e3], 400), "y0": 0.0, "sigma": 0.1,
                        "time": 2019.0 + rng.uniform(0, 1, 800)})
    pdf["x"] = pdf["x0"] + rng.uniform(-900, 900, 800)
    pdf["y"], pdf["z"] = rng.uniform(-900, 900, 800), 0.01 * rng.standard_normal(800)
    pdf.loc[pdf["x0"] > 0, "z"] += np.where(rng.random(400) < 0.1, 50, 0)
    points = spark.createDataFrame(pdf)
    factors = spark.createDataFrame([(x, 0.0, k, 1.0) for x in (0.0, 4e3) for k in range(34)],
                                    "x0 double, y0 double, node long, factor double")
    fit = robust_fit(points, spec, 5, factors=factors, update_mask=lambda t: factors)
    assert fit["z0"].groupBy("x0", "i", "j").count().where("count > 1").count() == 0
    assert fit["z0"].count() == 2 * spec.n_z0 and fit["data"].count() == 800


def test_scale_search_finds_noise_level(spark):
    rng = np.random.default_rng(11)
    ref = np.arange(0, 400)
    x = ref * 20.0
    z = 20 * np.sin(2 * np.pi * x / 1500) + 0.2 * rng.standard_normal(len(x))
    pdf = pd.DataFrame({
        "rgt": 1, "pair": 1, "ref_pt": ref, "cycle": 3, "x_atc": x, "z": z, "sigma": 0.2})
    data = spark.createDataFrame(pdf).withColumns({
        "rgt": F.col("rgt").cast("int"), "pair": F.col("pair").cast("int"), "cycle": F.col("cycle").cast("int")})
    curve = l_curve(data, 2000.0)
    one = curve.where("seg = 1").orderBy("scale").toPandas()
    assert len(one) == 10
    assert one["spread"].iloc[0] > one["spread"].iloc[-1]
    best = best_scale(curve).toPandas()
    ok = best["e_for_spread_1"].notna()
    assert ok.any()
    assert (best["e_10pct_above_min"].notna()).any()


def test_points_are_gathered_before_their_sums(spark):
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    for rows in (normal_equations(data, SPEC), fit_once(data, SPEC), design_rows(data, SPEC)):
        plan = rows._jdf.queryExecution().toString()
        assert "REBALANCE_PARTITIONS_BY_COL" in plan
        # pairs are summed in their tile, not shuffled one by one
        assert " b#" not in "".join(p for p in plan.splitlines() if "Exchange hashpartitioning" in p)


def test_passes_do_not_carry_columns_they_do_not_need(spark, monkeypatch):
    from icegrid.fit import robust

    held, cut = [], robust.cut_lineage
    monkeypatch.setattr(robust, "cut_lineage", lambda df: (held.append(df.columns), cut(df))[1])
    z = sine()
    z[[20, 50]] += 300
    data = frame(spark, part(z, -0.5, payload="p"), part(sine(), 0.5, payload="q"))
    fit = robust_fit(data.withColumn("nothing", F.lit(None)), SPEC)
    assert held and not any("payload" in columns for columns in held)
    out = fit["data"]
    assert set(out.columns) == {*data.columns, "nothing", "three_sigma_edit", "z_est"}
    off = out.where("not three_sigma_edit").toPandas()
    assert sorted(off["x"]) == [X[20], X[50]] and set(off["payload"]) == {"p"}
    # the flags returned are those that the last solution was made with
    again = fit_once(out.where("three_sigma_edit"), SPEC)
    a, b = (t.where("node >= 0").toPandas().set_index("node")["v"] for t in (again, fit["solution"]))
    assert np.abs(a - b).max() < 1e-6


def exchanges(df):
    """Shuffles that a plan makes."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_sums_stay_where_the_points_of_a_tile_lie(spark):
    from icegrid.fit import solve

    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    factors = data.select("x0", "y0").distinct().select(
        "x0", "y0", F.lit(0).cast("long").alias("node"), F.lit(2.0).alias("factor"))
    assert exchanges(fit_once(data, SPEC)) == 1
    whole = fit_once(data, SPEC, factors=factors)
    assert "CoGroup" in whole._jdf.queryExecution().executedPlan().toString()
    split = solve.solve_tiles(system_rows(data, SPEC, factors=factors, cells=system_rows(data, SPEC)), SPEC)
    a, b = (t.toPandas().set_index("node")["v"].sort_index() for t in (whole, split))
    assert np.abs(a - b).max() < 1e-9


def test_a_crowded_tile_is_summed_by_several_tasks(spark, monkeypatch):
    from icegrid.fit import design

    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    whole = fit_once(data, SPEC).toPandas().set_index("node")["v"].sort_index()
    monkeypatch.setattr(design, "CROWDED", 5)
    split = fit_once(data, SPEC)
    assert exchanges(split) == 3
    assert np.abs(whole - split.toPandas().set_index("node")["v"].sort_index()).max() < 1e-9


def test_a_solution_is_read_once(spark):
    data = frame(spark, part(sine(), -0.5), part(sine(), 0.5))
    plan = solution_tables(fit_once(data, SPEC), SPEC)["dz"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1


def test_errors_are_made_once_to_be_spread(spark):
    from icegrid.fit.errors import upsample_errors

    coarse = spark.createDataFrame(
        [(0.0, 0.0, i, j, float(i + j + 1)) for i in range(3) for j in range(3)],
        "x0 double, y0 double, i int, j int, sigma double")
    dear = coarse.mapInPandas(lambda parts: parts, coarse.schema)
    fine = upsample_errors(dear, ["x0", "y0"], 2)
    assert "MapInPandas" not in fine._jdf.queryExecution().executedPlan().toString()
    assert fine.count() == 25


def test_passes_of_a_tile_are_made_where_its_points_lie(spark, monkeypatch):
    from icegrid.fit import robust

    rng = np.random.default_rng(8)
    n = 300
    spec = FitSpec(width=2e3, z0_spacing=500, dz_spacing=1000, dt=1.0, t_start=2019.0, n_epochs=3, ref_epoch=0,
                   e_d2z0_dx2=1e-4, bias_params=("cycle",))
    pdf = pd.DataFrame({"x0": np.repeat([0.0, 4e3, 8e3], n // 3), "y0": 0.0, "sigma": 0.1, "sigma_corr": 0.2,
                        "cycle": rng.integers(0, 3, n), "time": 2019.0 + rng.uniform(0, 2, n)})
    pdf["x"], pdf["y"] = pdf["x0"] + rng.uniform(-1e3, 1e3, n), rng.uniform(-1e3, 1e3, n)
    pdf["z"] = np.sin(pdf["x"] / 500) + 0.1 * rng.standard_normal(n) + np.where(rng.random(n) < 0.1, 20, 0)
    pdf["editable"] = rng.random(n) < 0.9
    # a tile without heights, a point twice and one without a cycle's errors
    pdf.loc[pdf["x0"] == 8e3, "z"] = np.nan
    data = spark.createDataFrame(pd.concat([pdf, pdf[:1]], ignore_index=True)).replace(float("nan"), None)
    factor = F.when(F.col("z0") < 0, 3.0).otherwise(1.0).alias("factor")
    remade = lambda t: t["z0"].select("x0", "y0", (F.col("j") * 5 + F.col("i")).cast("long").alias("node"), factor)
    kept = []
    store = robust.stored
    monkeypatch.setattr(robust, "stored", lambda df, name: (kept.append(name), store(df, name))[1])

    def fit(**kw):
        out = robust_fit(data, spec, 4, **kw)
        rows = out["data"].toPandas().sort_values(["x0", "x", "y"]).reset_index(drop=True)
        return rows, out["solution"].toPandas().sort_values(["x0", "node"]).reset_index(drop=True)

    for how in ({}, {"update_mask": remade}):
        kept.clear()
        rows, nodes = fit(store=False, **how)
        assert not kept and len(rows) == len(data.collect())
        monkeypatch.setattr(robust, "HELD_POINTS", 10)
        split, other = fit(store=False, **how)
        monkeypatch.undo()
        monkeypatch.setattr(robust, "stored", lambda df, name: (kept.append(name), store(df, name))[1])
        assert (rows["three_sigma_edit"] == split["three_sigma_edit"]).all()
        assert 0 < (~rows["three_sigma_edit"])[rows["x0"] < 8e3].sum() < n / 2
        assert rows["z_est"].isna().equals(split["z_est"].isna())
        assert (rows["z_est"] - split["z_est"]).abs().max() < 1e-6
        assert (nodes["node"] == other["node"]).all() and (nodes["v"] - other["v"]).abs().max() < 1e-6
