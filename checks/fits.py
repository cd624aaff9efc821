"""The surface fit and connected parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import systems
from checks.rasters import ground_tracks
from checks.registry import query
from checks.tables import dz, grid, pts, r, rounded, sql, tiles, tpts
from icegrid.fit import (
    FitSpec, bias_groups, design_rows, edge_priors, fit_errors, normal_equations, robust_fit,
    sigma_extra, solution_tables,
)
from icegrid.fit.design import average_z0, constraint_scale, inside, node_mask
from icegrid.fit.errors import upsample_errors
from icegrid.fit.scales import best_scale, l_curve
from icegrid.fit.solve import fit_once, system_rows
from icegrid.operators import components
from icegrid.operators.tiles import neighbour_tiles
from icegrid.plans import region
from icegrid.plans.prepare import PointRules
from icegrid.session import scratch_dir, stored
from icegrid.sources.fits import read_fit

SPEC = FitSpec(
    width=6e4, z0_spacing=1e4, dz_spacing=2e4, dt=1.0, t_start=1995.0, n_epochs=8, ref_epoch=3,
    e_d2z0_dx2=0.02, e_d3z_dx2dt=0.0005, e_d2z_dt2=200000.0,
)
BY_CYCLE = FitSpec(**{**SPEC.__dict__, "bias_params": ("cycle",)})

# With the loose limits of SPEC, nodes beyond the points hang on rounding, so digits of two
# solvers differ there. Limits of slopes, the terms SPEC leaves out, make all nodes well known.
FIRM = FitSpec(**{**SPEC.__dict__, "e_dz0_dx": 0.02, "e_d2z_dxdt": 0.02, "e_d2z0_dx2": 2e-5, "e_d3z_dx2dt": 2e-6, "e_d2z_dt2": 200.0})
FIRM_BY_CYCLE = FitSpec(**{**FIRM.__dict__, "bias_params": ("cycle",)})

# nodes that fall on multiples of their spacing, so that the tiles of a map share them
ON_MAP = FitSpec(**{**FIRM_BY_CYCLE.__dict__, "dz_spacing": 1e4})

# nodes of a tile: 7 x 7 of the surface, then 8 epochs of 4 x 4 of its change
DESIGN = systems.observations(SPEC, "")


@query("design_sums", "FIT-1", sql("pts tpts", f"""
with {DESIGN} select x0, y0, node, count(*) n, {r('sum(c)', 'c_sum')} from nd where c <> 0 group by all"""))
def design_sums(spark, d):
    rows = design_rows(tpts(spark, d), SPEC)
    return rounded(rows.groupBy("x0", "y0", "node").agg(F.count("*").alias("n"), F.sum("c").alias("c_sum")))


@query("normal_equations", "FIT-2", sql("pts tpts", f"""
with {DESIGN}, nz as (select * from nd where c <> 0)
select a.x0, a.y0, a.node a, b.node b, {r('sum(a.c*b.c/(a.sigma*a.sigma))', 'v', 2)} from nz a join nz b on a.k = b.k and b.node >= a.node group by 1, 2, 3, 4
union all select x0, y0, node, -1, {r('sum(c*z/(sigma*sigma))', 'v', 2)} from nz group by 1, 2, 3"""))
def normal_sums(spark, d):
    return rounded(normal_equations(tpts(spark, d), SPEC), 2)


@query("bias_groups", "FIT-5", sql("pts tpts", f"""
select x0, y0, rgt, "cycle", pair, {r('median(sigma_corr)', 'expected')},
  cast(1099511627776 as bigint) + (cast(rgt as bigint)*131072+"cycle")*131072+pair node from tpts group by all"""))
def bias_table(spark, d):
    return rounded(bias_groups(tpts(spark, d), ("rgt", "cycle", "pair")))


@query("constraint_scales", "FIT-4", sql("pts tiles grid", f"""
select x0, y0, j, i, x0-3e4+i*2e4 x, y0-3e4+j*2e4 y, {r('v', 'scale')} from
 (select x0, y0, i, unnest(range(0, 4))::int j from (select *, unnest(range(0, 4))::int i from tiles)) n
 left join grid g on g.ix = round((x0-3e4+i*2e4)/1e4) and g.iy = round((y0-3e4+j*2e4)/1e4)"""))
def constraint_scales(spark, d):
    g = grid(spark, d).select("ix", "iy", "v")
    return rounded(constraint_scale(tiles(spark, d), g, SPEC, 1e4))


@query("sigma_extra", "FIT-8", sql("pts", f"""
select cast(round_even(x/1e4,0) as int) bi, cast(round_even(y/1e4,0) as int) bj,
 {r('least(sqrt(greatest(pow((quantile_cont(z-dem_h,0.84)-quantile_cont(z-dem_h,0.16))/2,2)-median(sigma*sigma),0)),400)', 'sigma_extra')}
from pts group by 1, 2"""))
def sigma_extras(spark, d):
    p = pts(spark, d).withColumn("r", F.col("z") - F.col("dem_h"))
    return rounded(sigma_extra(p, 1e4, 400.0))


@query("surface_fit", "FIT-6 FIT-3", sql("pts tpts", f"""
with recursive {systems.observations(FIRM_BY_CYCLE, "")},
biases as (select x0, y0, {systems.FIRST_BIAS}+"cycle" node, median(sigma_corr) expected from u group by all),
{systems.fitted(FIRM_BY_CYCLE, "", biases="biases")},
change as (select x0, y0, node, v from sol where node between 49 and 176
  union all select x0, y0, 97+range, 0e0 from t, range(16))
select x0, y0, cast((node-49)%4 as int) i, cast((node-49)//4%4 as int) j, cast((node-49)//16 as int) it, {r('v', 'dz', 3)},
  x0-3e4+(node-49)%4*2e4 x, y0-3e4+(node-49)//4%4*2e4 y, 1995e0+(node-49)//16*1e0 t from change"""))
def surface_fit(spark, d):
    """All tiles, with one bias per cycle."""
    p = tpts(spark, d).where(inside(FIRM_BY_CYCLE))
    biases = bias_groups(p, FIRM_BY_CYCLE.bias_params)
    return rounded(solution_tables(fit_once(p, FIRM_BY_CYCLE, biases), FIRM_BY_CYCLE)["dz"], 3)


@query("masked_fit", "FIT-14 AGG-6", sql("pts tpts grid", f"""
with recursive {systems.observations(FIRM, "")},
narrow as (select a.ix, a.iy, case when count(*) = 9 then min(b.mask) else 0 end mask from grid a join grid b
  on b.ix between a.ix-1 and a.ix+1 and b.iy between a.iy-1 and a.iy+1 group by all),
spot as (select x0, y0, node, round(x0/1e4)-3+(node%7) ix, round(y0/1e4)-3+node//7 iy from (select distinct x0, y0 from tpts), range(49) r(node)
  union all select x0, y0, 49+n, round(x0/1e4)-3+n%4*2, round(y0/1e4)-3+n//4*2 from (select distinct x0, y0 from tpts), range(16) r(n)),
factors as (select x0, y0, node, case when mask > 0.5 then 1e0 else 10e0 end factor from spot left join narrow using (ix, iy)),
{systems.fitted(FIRM, "", factors="factors")}
select x0, y0, cast(node%7//2 as int) i, cast(node//7//2 as int) j, {r('avg(v)', 'z0', 3)} from sol where node < 49 group by 1, 2, 3, 4"""))
def masked_fit(spark, d):
    """Constraints are relaxed off the narrowed mask; the surface is averaged to the change grid."""
    p = tpts(spark, d)
    mask = grid(spark, d).select("ix", "iy", "mask")
    factors = node_mask(p.select("x0", "y0").distinct(), mask, FIRM, 1e4, erode_cells=1)
    return rounded(average_z0(solution_tables(fit_once(p, FIRM, factors=factors), FIRM)["z0"], FIRM), 3)


def _passes(n: int, remade: str = "") -> str:
    """Passes 1 ... n of the edited fit; done{k} holds the points whose tile ends with pass k.

    remade makes factors{k} of pass k from the solution sol{j} of the one before."""
    out = ["used1 as materialized (select k, x0, y0, true flag from u)"]
    for k in range(1, n + 1):
        cons = "" if k == 1 else f"cons{k} as (select * from cons1),"
        factors = None
        if remade and k > 1:
            factors = f"factors{k}"
            cons += f"{factors} as ({remade.format(j=k - 1)}),"
        first = f"{systems.STENCILS},{systems.constraints(FIRM, '1')}," if k == 1 else ""
        out.append(f"""
nd{k} as (select nd.* from nd join used{k} using (k) where flag),{first}{cons}{systems.solved(FIRM, str(k), factors=factors)},
est{k} as (select k, sum(c*coalesce(v, 0)) z_est from nd left join sol{k} using (x0, y0, node) group by k),
res{k} as materialized (select k, p.x0, p.y0, flag, z_est, (z-z_est)/sigma rs from used{k} p join est{k} using (k) join u using (k)),
new{k} as materialized (select k, x0, y0, z_est, flag, abs(rs) < 3*greatest(spread, 1) good from res{k} join (
  select x0, y0, (quantile_cont(rs, 0.84)-quantile_cont(rs, 0.16))/2 spread from res{k} where flag group by all) using (x0, y0)),
going{k} as materialized (select x0, y0 from new{k} group by all having avg(cast(good <> flag as int)) >= 0.001 and {k} < {n}),
done{k} as (select k, z_est, flag from new{k} anti join going{k} using (x0, y0)),
used{k + 1} as materialized (select k, x0, y0, good flag from new{k} semi join going{k} using (x0, y0))""")
    return ",".join(out)


@query("robust_fit", "FIT-7", sql("pts tpts", f"""
with recursive {systems.observations(FIRM, "")},{_passes(4)}
select x0, y0, oid, lno, ref_pt, {r('z', 'z', 3)}, {r('z_est', 'z_est', 3)}, flag three_sigma_edit
from u join ({' union all '.join(f"select * from done{k}" for k in range(1, 5))}) using (k)"""))
def edited_fit(spark, d):
    fit = robust_fit(tpts(spark, d), FIRM, max_iterations=4, store=False)
    out = fit["data"].select("x0", "y0", "oid", "lno", "ref_pt", "z", "z_est", "three_sigma_edit")
    return rounded(out, 3)


# below this height a pass takes the ground as off the mask in the next one
LEVEL = 150.0
REMADE = f"""select x0, y0, node, case when v < {LEVEL} then 10e0 else 1e0 end factor from sol{{j}} where node < 49
  union all select x0, y0, 49 + node//14*4 + node%7//2, case when v < {LEVEL} then 10e0 else 1e0 end
  from sol{{j}} where node < 49 and node%7%2 = 0 and node//7%2 = 0"""


@query("remasked_fit", "FIT-13 FIT-7", sql("pts tpts", f"""
with recursive {systems.observations(FIRM, "")},{_passes(3, REMADE)}
select x0, y0, oid, lno, ref_pt, {r('z', 'z', 3)}, {r('z_est', 'z_est', 3)}, flag three_sigma_edit
from u join ({' union all '.join(f"select * from done{k}" for k in range(1, 4))}) using (k)"""))
def remasked_fit(spark, d):
    """Each pass makes the mask of the next one: where the surface is low, limits are relaxed."""

    def update_mask(tables):
        factor = F.when(F.col("z0") < LEVEL, 10.0).otherwise(1.0).alias("factor")
        z0 = tables["z0"]
        own = z0.select("x0", "y0", (F.col("j") * 7 + F.col("i")).cast("long").alias("node"), factor)
        both = z0.where((F.col("i") % 2 == 0) & (F.col("j") % 2 == 0))
        node = 49 + F.col("j") / 2 * 4 + F.col("i") / 2
        return own.unionByName(both.select("x0", "y0", node.cast("long").alias("node"), factor))

    fit = robust_fit(tpts(spark, d), FIRM, max_iterations=3, update_mask=update_mask, store=False)
    out = fit["data"].select("x0", "y0", "oid", "lno", "ref_pt", "z", "z_est", "three_sigma_edit")
    return rounded(out, 3)


@query("stored_points", "SNK-7 SRC-6", sql("pts tpts", f"""
with s as (select * from tpts where sigma < 0.2e0),
q as (select *, floor((x-(x0-3e4))/7500) bi, floor((y-(y0-3e4))/7500) bj, z-dem_h r from s),
m as (select x0, y0, bi, bj, median(r) med from q group by all)
select x0, y0, oid, lno, ref_pt, {r('z', 'z')}, abs(r-med) < 300 three_sigma_edit
from q join m using (x0, y0, bi, bj) where y0 >= 0 and y >= y0"""))
def stored_points(spark, d):
    """A run that stops at the points; the northern half of the northern tiles is read back."""
    path = scratch_dir(spark, "points")
    rules = PointRules(sigma_tol=0.2, dem_tol=300.0, min_points=1, min_span=0.0)
    region.prelim(pts(spark, d), rules, FIRM, path, mode="data_only")
    back = read_fit(spark, path, "data").where("y0 >= 0 and y >= y0")
    return rounded(back.select("x0", "y0", "oid", "lno", "ref_pt", "z", "three_sigma_edit"))


@query("fit_errors", "FIT-10 RAS-6 JON-3", sql("pts tpts", f"""
with recursive {systems.observations(FIRM.coarser(2, 1), "")},{systems.fitted(FIRM.coarser(2, 1), "", variances=True)},
coarse as (select x0, y0, node%4 i, node//4 j, sqrt(var) s from sol where node < 16)
select x0, y0, cast(a.i as int) i, cast(b.j as int) j, {r("sum(s*(1-abs(a.i/2e0-coarse.i))*(1-abs(b.j/2e0-coarse.j)))", 'sigma', 5)}
from coarse, range(7) a(i), range(7) b(j) where abs(a.i/2e0-coarse.i) < 1 and abs(b.j/2e0-coarse.j) < 1 group by 1, 2, 3, 4"""))
def error_fit(spark, d):
    """Errors on a coarser grid, brought to the spacing of the fit."""
    coarse = FIRM.coarser(2, 1)
    rows = system_rows(tpts(spark, d), coarse)
    errors = fit_errors(rows, coarse, lags=(1,), scales=(60000,))
    return rounded(upsample_errors(errors.where("field = 'z0'"), ["x0", "y0"], 2), 5)


@query("matched_fit", "FIT-9 JON-9", sql("pts tpts", f"""
with recursive {systems.observations(FIRM, "1")},{systems.fitted(FIRM, "1", variances=True)},
spot as (select x0 nx0, y0 ny0, node, v, sqrt(var) s, case when node < 49 then 1e4 else 2e4 end step, case when node < 49 then 7 else 4 end n,
  case when node < 49 then 0 else (node-49)//16*16+49 end base from sol1),
place as (select *, nx0-3e4+(node-base)%n*step x, ny0-3e4+(node-base)//n*step y from spot),
held as (select t.x0, t.y0, base+cast(round((y-t.y0+3e4)/step)*n+round((x-t.x0+3e4)/step) as bigint) a, 1/(4*s*s) w, v from place p join t1 t
  on abs(t.x0-nx0) <= 4e4 and abs(t.y0-ny0) <= 4e4 and (t.x0 <> nx0 or t.y0 <> ny0)
  where greatest(abs(x-t.x0), abs(y-t.y0)) between 29e3 and 3e4 and s > 0),
priors as (select x0, y0, a, a b, w v from held union all select x0, y0, a, -1, w*v from held),
nd2 as (select * from nd1), cons2 as (select * from cons1), {systems.solved(FIRM, "2", priors="priors")}
select x0, y0, cast(node%7 as int) i, cast(node//7 as int) j, {r('v', 'z0', 3)}, x0-3e4+node%7*1e4 x, y0-3e4+node//7*1e4 y
from sol2 where node < 49"""))
def matched_fit(spark, d):
    """Fit again with the edges held near the neighbours' first solutions."""
    p = tpts(spark, d)
    rows = stored(system_rows(p, FIRM), "sums")
    tables = solution_tables(stored(fit_once(p, FIRM, cells=rows), "first"), FIRM)
    errors = stored(fit_errors(rows, FIRM, lags=()), "errors")
    s0 = errors.where("field = 'z0'").select("x0", "y0", "i", "j", F.col("sigma").alias("sigma_z0"))
    s1 = errors.where("field = 'dz' and lag = 0").select(
        "x0", "y0", "i", "j", "it", F.col("sigma").alias("sigma_dz"))
    first = {
        "z0": tables["z0"].join(s0, ["x0", "y0", "i", "j"]),
        "dz": tables["dz"].join(s1, ["x0", "y0", "i", "j", "it"]),
    }
    near = neighbour_tiles(p.select("x0", "y0").distinct(), 4e4)
    priors = edge_priors(near, first, FIRM, 4e4, include=1000.0, sigma_scale=2.0)
    return rounded(solution_tables(fit_once(p, FIRM, priors=priors, cells=rows), FIRM)["z0"], 3)


@query("scale_search", "FIT-12 WIN-5 WIN-6")
def scale_search(spark, d):
    """Places lie 20 m apart along their tracks."""
    p = ground_tracks(spark, d).withColumn("x_atc", F.col("ref_pt") * 20.0)
    return best_scale(l_curve(p, 2000.0, min_fill=0.5))


@query("masked_components", "AGG-15", sql("pts dz", """
with recursive ok as (select ix, iy, cast(ix as bigint)*1000000+iy id from dz where cell_area > 0 group by ix, iy
   having (ix, iy) in (select (ix, iy) from dz where cell_area > 0 group by ix, iy having min(cell_area) > 1e6)),
reach as (select ix, iy, id from ok union
  select o.ix, o.iy, r.id from reach r join ok o on abs(o.ix-r.ix)+abs(o.iy-r.iy) = 1),
part as (select ix, iy, min(id) label from reach group by ix, iy),
span as (select label, min(it) i0, max(it) i1 from dz join part using (ix, iy) where "count" > 1 group by label)
select ix, iy, it, case when label is null or it between i0 and i1 then dz end dz,
  case when label is null then 0e0 else cell_area end cell_area
from dz left join part using (ix, iy) left join span using (label)"""))
def masked_components(spark, d):
    """Parts of the cells whose area is above one unit in every quarter that has any."""
    seen = dz(spark, d).where("cell_area > 0").groupBy("ix", "iy").agg(F.min("cell_area").alias("_a"))
    marked = dz(spark, d).join(seen, ["ix", "iy"], "left").withColumn(
        "cell_area", F.when(F.col("_a") > 1e6, F.col("cell_area")).otherwise(0.0)).drop("_a")
    return components.mask_by_component(marked).select("ix", "iy", "it", "dz", "cell_area")


@query("edge_points", "JON-8 SET-5 SRC-6", sql("pts tpts", """
with held as (select p.*, n.nx0, n.ny0 from tpts p join (
   select distinct nx0, ny0, nx0+i x0, ny0+j y0 from (select distinct x0+m.i nx0, y0+m.j ny0 from tpts,
     (values (-2e4,0e0),(2e4,0e0),(0e0,2e4),(0e0,-2e4)) m(i,j)), (values (-2e4),(0e0),(2e4)) a(i), (values (-2e4),(0e0),(2e4)) b(j)) n
   using (x0, y0) where sigma < 0.2e0 and abs(x-nx0) <= 3e4 and abs(y-ny0) <= 3e4),
b as (select *, round_even((x-5000)/1e4,0)*1e4+5000 bx, round_even((y-5000)/1e4,0)*1e4+5000 byy from held),
o as (select nx0, ny0, bx, byy, arg_min({'x0': x0, 'y0': y0}, (((bx-x0)*(bx-x0)+(byy-y0)*(byy-y0))::double, x0, y0)) o
  from (select distinct nx0, ny0, bx, byy, x0, y0 from b) group by all)
select b.nx0 x0, b.ny0 y0, b.x0 source_x0, b.y0 source_y0, count(*) n, sum(z) z_sum from b
join o using (nx0, ny0, bx, byy) where b.x0 = o.o.x0 and b.y0 = o.o.y0 group by all"""))
def edge_points(spark, d):
    """Tiles between the stored ones, made of the points of the nearest of these."""
    path = scratch_dir(spark, "points")
    rules = PointRules(sigma_tol=0.2, dem_tol=None, min_points=1, min_span=0.0)
    region.store_points(pts(spark, d), rules, path)
    found = region.step_points(spark, path, "edges", 6e4, 4e4)
    return found.groupBy("x0", "y0", "source_x0", "source_y0").agg(
        F.count("*").alias("n"), F.sum("z").alias("z_sum"))


@query("region_products", "SNK-1 SNK-2 SNK-3 SNK-4 SRC-6 FIT-6 FIT-7 FIT-9 FIT-10 FIT-11 MOS-1 MOS-4")
def region_products(spark, d):
    """First fits, errors, matched fits, mosaics and products, step by step on disk."""
    first, second = scratch_dir(spark, "prelim"), scratch_dir(spark, "matched")
    rules = PointRules(sigma_tol=0.2, dem_tol=400.0, edit_width=4e4)
    region.prelim(pts(spark, d), rules, ON_MAP, first, max_iterations=2)
    region.errors(spark, first, ON_MAP, scale=(2, 2), lags=(1, 2), scales=(20000, 40000))
    region.matched(spark, first, second, ON_MAP, 4e4, sigma_scale=2.0)
    grids = region.mosaics(spark, second, first, ON_MAP, 4e4, (20000, 40000))
    grids["dz"] = grids["dz"].withColumn("t", F.col("t") + 24)
    out = region.region_products(grids, ON_MAP, (1, 2), (20000, 40000))
    dem = out["dem"].select("x", "y", F.col("h").alias("value"), F.col("h_sigma").alias("sigma"))
    change = out["change"].select(
        "scale_m", "lag", "x", "y", "time", F.coalesce("delta_h", "dhdt").alias("value"),
        F.coalesce("delta_h_sigma", "dhdt_sigma").alias("sigma"))
    return change.unionByName(dem, allowMissingColumns=True)
