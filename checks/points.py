"""Filters, edits, thinning, joins and statistics of points."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import grid, pts, r, rounded, sql, table, tiles, tpts
from icegrid.operators import aggregate, filters, points
from icegrid.operators import tiles as tile_ops
from icegrid.session import scratch_dir
from icegrid.sources import points as source

BOX = (-60000.0, 260000.0, -40000.0, 80000.0)
IN_BOX = "x between -60000 and 260000 and y between -40000 and 80000"


@query("points_in_box", "SRC-1 SRC-2 FLT-1", sql("pts", f"""
select oid, lno, x, y, z from pts where {IN_BOX}"""))
def points_in_box(spark, d):
    """Written in bins, then read back by box."""
    path = scratch_dir(spark, "points")
    source.write_binned(pts(spark, d), path)
    return source.read_points(spark, path, BOX, ["oid", "lno", "x", "y", "z"])


@query("bin_counts", "SRC-2", sql("pts", """
select cast(floor(x/2e5) as int) bx, cast(floor(y/2e5) as int) by_, count(*) n from pts group by all"""))
def bin_counts(spark, d):
    return source.bin_counts(pts(spark, d))


def xover_groups(spark, d):
    p = pts(spark, d).where("not along_track").withColumns({
        "file": F.concat(F.lit("x"), F.col("sid").cast("string")),
        "row_id": F.struct("oid", "ref_pt", "lno", "z", "delta_time"),
        "cyc": F.when(F.col("cycle") % 2 == 0, 1).otherwise(2),
    })
    keys = ["file", "row_id"]
    root = p.select(*keys, "x", "y", "dem_h", "geoid_h", "n_slope", "e_slope", F.col("cyc").alias("cycle"))
    crossing = p.select(
        *keys, "rgt", F.col("pair").alias("pair_track"), F.col("z").alias("h_corr"),
        F.col("sigma").alias("h_corr_sigma"), F.col("sigma_corr").alias("h_corr_sigma_systematic"),
        "tide_ocean", "dac", "delta_time",
    )
    datum = p.select(
        *keys, F.col("sid").alias("rgt"), "ref_pt",
        (F.col("lno") % 2 + 1).cast("int").alias("pair_track"), "fit_quality",
    )
    return root, crossing, datum


@query("crossovers", "SRC-3 SRC-4 AGG-1", sql("pts", f"""
with xo as (select *, case when "cycle" % 2 = 0 then 1 else 2 end xc,
   cast(lno % 2 + 1 as int) ref_pair from pts where not along_track and {IN_BOX})
select rgt, ref_rgt, pair, ref_pair, "cycle", z, sigma, ref_pt, delta_time from (
 select rgt, sid ref_rgt, pair, ref_pair, xc as "cycle", z, sigma, ref_pt, delta_time,
  row_number() over (partition by rgt, sid, pair, ref_pair, xc order by sigma, sid, oid, ref_pt, lno, z, delta_time) k
 from xo) where k = 1"""))
def crossovers(spark, d):
    path = scratch_dir(spark, "xover")
    source.write_xovers(*xover_groups(spark, d), path)
    out = source.read_xovers(spark, path, BOX)
    return out.select("rgt", "ref_rgt", "pair", "ref_pair", "cycle", "z", "sigma", "ref_pt", "delta_time")


@query("best_crossovers", "AGG-1", sql("pts", """
select rgt, pair, ref_pt, "cycle", sigma, z, oid, lno from (select *,
  row_number() over (partition by rgt, pair, ref_pt, "cycle" order by sigma, oid, lno, z) k from pts)
where k = 1"""))
def best_crossovers(spark, d):
    p = pts(spark, d).select("rgt", "pair", "ref_pt", "cycle", "sigma", "z", "oid", "lno")
    return points.best_xover(p, ["oid", "lno", "z"], ["rgt", "pair", "ref_pt", "cycle"])


@query("cycle_counts", "AGG-2", sql("pts", """
select oid, lno, rgt, pair, ref_pt, tide_ocean,
  count(tide_ocean) over (partition by rgt, pair, ref_pt) n_cycles from pts"""))
def cycle_counts(spark, d):
    out = points.n_cycles(pts(spark, d), ["rgt", "pair", "ref_pt"], "tide_ocean")
    return out.select("oid", "lno", "rgt", "pair", "ref_pt", "tide_ocean", "n_cycles")


@query("union_of_points", "SET-1", sql("pts", """
select oid, lno, z, case when along_track then ref_pt*20 end x_atc from pts"""))
def union_of_points(spark, d):
    p = pts(spark, d).select("oid", "lno", "z", "along_track", "ref_pt")
    along = p.where("along_track").select("oid", "lno", "z", (F.col("ref_pt") * 20).alias("x_atc"))
    return points.union_points(along, p.where("not along_track").select("oid", "lno", "z"))


@query("sigma_and_geoid_filter", "FLT-2 FLT-4", sql("pts", """
select oid, lno, z from pts where sigma < 0.15e0 and z - geoid_h > 5"""))
def sigma_and_geoid_filter(spark, d):
    return filters.above_geoid(filters.below_sigma(pts(spark, d), 0.15), 5).select("oid", "lno", "z")


@query("edit_list", "FLT-3", sql("pts tpts", """
with m as (select x0, y0, avg(x) mx, avg(y) my from tpts group by all)
select t.x0, t.y0, rgt, "cycle", count(*) n from tpts t join m using (x0, y0)
where not (rgt = 41 and "cycle" = 20)
  and not (rgt = 12 and "cycle" = 30 and greatest(abs(mx-40000), abs(my+20000)) < 5e4)
group by all"""))
def edit_list(spark, d):
    edits = spark.createDataFrame(
        [(41, 20, None, None, None), (12, 30, 40000.0, -20000.0, 5e4)], filters.EDIT_SCHEMA
    )
    out = filters.apply_edit_list(tpts(spark, d), edits, ["x0", "y0"])
    return out.groupBy("x0", "y0", "rgt", "cycle").agg(F.count("*").alias("n"))


INTERP = """
i2 as (select p.*, fx, fy,
  (1-fx)*(1-fy) w00, fx*(1-fy) w10, (1-fx)*fy w01, fx*fy w11, a.{f} v00, b.{f} v10, c.{f} v01, d.{f} v11
 from (select *, floor(x/1e4) cx, floor(y/1e4) cy, x/1e4-floor(x/1e4) fx, y/1e4-floor(y/1e4) fy from {src}) p
 left join grid a on a.ix = cx and a.iy = cy left join grid b on b.ix = cx+1 and b.iy = cy
 left join grid c on c.ix = cx and c.iy = cy+1 left join grid d on d.ix = cx+1 and d.iy = cy+1)"""
BLEND = ("(case when w00 = 0 then 0 else w00*v00 end + case when w10 = 0 then 0 else w10*v10 end"
         " + case when w01 = 0 then 0 else w01*v01 end + case when w11 = 0 then 0 else w11*v11 end)")


def interp_cte(src: str, field: str) -> str:
    return INTERP.format(src=src, f=field)


@query("reference_residual", "FLT-5 JON-1", sql("pts tpts grid", f"""
with {interp_cte('tpts', 'v')}, q as (select *, {BLEND} z_ref from i2)
select x0, y0, count(*) n, {r('min(z-z_ref)', 'lo', 5)}, {r('max(z-z_ref)', 'hi', 5)}
from q where abs(z-z_ref) < 300 group by all"""))
def reference_residual(spark, d):
    dem = grid(spark, d).withColumnRenamed("v", "h")
    kept, _ = filters.subtract_reference(tpts(spark, d), dem, 1e4, 300, ["x0", "y0"])
    return rounded(kept.groupBy("x0", "y0").agg(
        F.count("*").alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")), 5)


@query("reference_sigma", "FLT-5", sql("pts tpts grid", f"""
with {interp_cte('tpts', 'h_sigma')}
select x0, y0, {r(f'median({BLEND})', 'sigma_ref_median')} from i2 group by all
having median({BLEND}) is not null"""))
def reference_sigma(spark, d):
    dem = grid(spark, d).withColumnRenamed("v", "h")
    return rounded(filters.subtract_reference(tpts(spark, d), dem, 1e4, 300, ["x0", "y0"])[1])


@query("dem_block_edit", "FLT-6 FLT-7", sql("pts tpts", """
with q as (select *, floor((x-(x0-3e4))/7500) bi, floor((y-(y0-3e4))/7500) bj, z-dem_h r from tpts),
m as (select x0, y0, bi, bj, median(r) med from q group by all)
select x0, y0, oid, lno, ref_pt, abs(r-med) < 300 as three_sigma_edit,
  abs(x-x0) <= 15000 and abs(y-y0) <= 15000 editable
from q join m using (x0, y0, bi, bj)"""))
def dem_block_edit(spark, d):
    out = filters.dem_block_edit(tpts(spark, d), 6e4, 300, ["x0", "y0"])
    return filters.editable(out, 3e4).select(
        "x0", "y0", "oid", "lno", "ref_pt", "three_sigma_edit", "editable")


@query("restarted_edit", "FLT-8", sql("pts", "select oid, lno, true as three_sigma_edit from pts"))
def restarted_edit(spark, d):
    p = pts(spark, d).select("oid", "lno", (F.col("z") > 100).alias("three_sigma_edit"))
    return filters.restart_edit(p)


@query("tile_gate", "FLT-9", sql("pts tpts", f"""
select x0, y0, count(*) n, {r('max("time")-min("time")', 'span')},
  count(*) filter (where greatest(abs(x-x0), abs(y-y0)) < 20000) n_inner
from tpts group by all
having count(*) >= 10 and max("time")-min("time") >= 80e0/365e0
  and count(*) filter (where greatest(abs(x-x0), abs(y-y0)) < 20000) >= 50"""))
def tile_gate(spark, d):
    return rounded(filters.sufficient_tiles(tpts(spark, d), ["x0", "y0"], 6e4, 1e4))


@query("gated_points", "FLT-9", sql("pts tpts", """
select x0, y0, count(*) n from tpts group by all having count(*) >= 700
  and max("time")-min("time") >= 80e0/365e0"""))
def gated_points(spark, d):
    kept = filters.gate_tiles(tpts(spark, d), ["x0", "y0"], 6e4, min_points=700)
    return kept.groupBy("x0", "y0").agg(F.count("*").alias("n"))


@query("selected_tiles", "FLT-10", sql("pts tiles", """
select x0, y0 from tiles where x0 between -80000 and 400000 and y0 > -80000 and y0 < 80000
 and sqrt(x0*x0+y0*y0) > 30000 and sqrt(x0*x0+y0*y0) < 390000
 and greatest(abs(x0), abs(y0)) >= 40000 and greatest(abs(x0), abs(y0)) <= 360000"""))
def selected_tiles(spark, d):
    return filters.select_tiles(
        tiles(spark, d), (-8e4, 4e5, -8e4, 8e4), min_r=3e4, max_r=3.9e5, min_xy=4e4, max_xy=3.6e5)


@query("pending_tiles", "FLT-12", sql("pts tiles", """
select x0, y0 from tiles where not (x0 > 0 and y0 > 0) and y0 >= -40000 and x0 <= 200000"""))
def pending_tiles(spark, d):
    t = tiles(spark, d)
    return filters.pending_tiles(
        t, done=t.where("x0 > 0 and y0 > 0"), listed=t.where("y0 >= -40000"),
        required=t.where("x0 <= 200000"))


@query("good_surface", "FLT-13", sql("pts grid", f"""
with {interp_cte('pts', 'mask')}
select oid, lno, z, tide_ocean from i2 where {BLEND} > 0.5 and fit_quality < 1 and z is not null and sigma > 0"""))
def good_surface(spark, d):
    mask = grid(spark, d).select("ix", "iy", "mask")
    return filters.good_surface(pts(spark, d), mask, 1e4).select("oid", "lno", "z", "tide_ocean")


@query("pole_hole", "FLT-14", sql("pts grid", """
select ix, iy, case when -70-abs(iy)*2 < -88 then 0 else mask end mask from grid"""))
def pole_hole(spark, d):
    lat = -70 - F.abs(F.col("iy")) * 2
    return filters.cut_pole_hole(grid(spark, d), lat, ["mask"]).select("ix", "iy", "mask")


@query("decimated_points", "AGG-4 WIN-4", sql("pts", """
with b as (select *, cast(round_even((x-(0-3e4+2500))/5000,0) as int) bi,
   cast(round_even((y-(0-3e4+2500))/5000,0) as int) bj, ref_pt+2006500e0*rgt g from pts),
k as (select bi, bj, g, dense_rank() over (partition by bi, bj order by g)-1 r,
   count(*) over (partition by bi, bj) / 25e6 / (8e3/3.6e9) step from b where along_track),
keep as (select distinct bi, bj, g from k where step < 1 or floor(ceil(r/step)*step) = r)
select oid, lno, ref_pt, along_track from b where not along_track
union all select oid, lno, ref_pt, along_track from b join keep using (bi, bj, g) where along_track"""))
def decimated_points(spark, d):
    out = points.decimate(pts(spark, d), 6e4, n_target=8e3)
    return out.select("oid", "lno", "ref_pt", "along_track")


@query("tile_assignment", "JON-5", sql("pts tpts", """
select x0, y0, count(*) n, sum(z) z_sum from tpts group by all"""))
def tile_assignment(spark, d):
    return tpts(spark, d).groupBy("x0", "y0").agg(F.count("*").alias("n"), F.sum("z").alias("z_sum"))


@query("overlap_resolved", "JON-8", sql("pts tpts", """
with b as (select *, round_even((x-5000)/1e4,0)*1e4+5000 bx, round_even((y-5000)/1e4,0)*1e4+5000 byy from tpts),
o as (select bx, byy, arg_min({'x0': x0, 'y0': y0}, (((bx-x0)*(bx-x0)+(byy-y0)*(byy-y0))::double, x0, y0)) o
  from (select distinct bx, byy, x0, y0 from b) group by all)
select b.x0, b.y0, count(*) n, sum(z) z_sum from b join o on b.bx = o.bx and b.byy = o.byy
  and b.x0 = o.o.x0 and b.y0 = o.o.y0 group by all"""))
def overlap_resolved(spark, d):
    return tile_ops.nearest_tile_dedupe(tpts(spark, d)).groupBy("x0", "y0").agg(
        F.count("*").alias("n"), F.sum("z").alias("z_sum"))


@query("neighbour_tiles", "JON-9", sql("pts tiles", """
select a.x0, a.y0, b.x0 nx0, b.y0 ny0 from tiles a join tiles b
  on abs(a.x0-b.x0) in (0, 40000) and abs(a.y0-b.y0) in (0, 40000)"""))
def neighbour_tiles(spark, d):
    return tile_ops.neighbour_tiles(tiles(spark, d), 4e4)


@query("step_tiles", "SET-5", sql("pts tiles", """
select 'corners' step, * from (select distinct x0+i x0, y0+j y0 from tiles,
  (values (-2e4,-2e4),(2e4,-2e4),(-2e4,2e4),(2e4,2e4)) m(i,j))
union all select 'edges', * from (select distinct x0+i x0, y0+j y0 from tiles,
  (values (-2e4,0e0),(2e4,0e0),(0e0,2e4),(0e0,-2e4)) m(i,j))"""))
def step_tiles(spark, d):
    t = tiles(spark, d)
    return tile_ops.step_tiles(t, "corners", 4e4).select(F.lit("corners").alias("step"), "x0", "y0").unionAll(
        tile_ops.step_tiles(t, "edges", 4e4).select(F.lit("edges").alias("step"), "x0", "y0"))


@query("node_misfit", "AGG-5", sql("pts", f"""
with c as (select *, floor(x/1e4) cx, floor(y/1e4) cy, x/1e4-floor(x/1e4) fx, y/1e4-floor(y/1e4) fy, z-dem_h rr from pts),
e as (select cast(cx+i as int) ix, cast(cy+j as int) iy,
  case when i=1 then fx else 1-fx end * case when j=1 then fy else 1-fy end w, rr, sigma
  from c, (values (0,0),(1,0),(0,1),(1,1)) m(i,j))
select ix, iy, {r('sum(w)', 'count')}, {r('sqrt(sum(w*rr*rr)/sum(w))', 'misfit_rms')},
 {r('sqrt(sum(w*(rr/sigma)*(rr/sigma))/sum(w))', 'misfit_scaled_rms', 4)}
from e where w > 0 group by all""").replace("as count,", 'as "count",'))
def node_misfit(spark, d):
    p = pts(spark, d).withColumn("r", F.col("z") - F.col("dem_h"))
    out = aggregate.cell_misfit(p, 1e4)
    four = rounded(out.select("ix", "iy", "misfit_scaled_rms"), 4)
    return rounded(out.drop("misfit_scaled_rms")).join(four, ["ix", "iy"])


@query("dem_report", "AGG-9", sql("pts tpts", f"""
with q as (select *, z-dem_h rr, z > 200 k, tide_ocean s from tpts)
select x0, y0, {", ".join(f"count(*) filter (where k and s is not null and abs(rr) > {t}) n_{t}, count(*) filter (where abs(rr) > {t}) n_raw_{t}, round(sqrt(avg(s*s) filter (where k and s is not null and abs(rr) > {t})) + 17e-9,6)+0.0 rss_sigma_{t}" for t in (100, 50, 25, 0))},
 {", ".join(f"count(*) filter (where k and s > {c}) n_sigma_{c}, count(*) filter (where s > {c}) n_sigma_raw_{c}" for c in (0, 1, 2, 4, 8, 16, 32, 64))},
 {r('stddev_pop(rr) filter (where k)', 'std_dem')},
 case when count(*) filter (where k and s is not null and abs(rr) > 100) > 0 then 100
  when count(*) filter (where k and s is not null and abs(rr) > 50) > 0 then 50
  when count(*) filter (where k and s is not null and abs(rr) > 25) > 0 then 25
  when count(*) filter (where k and s is not null and abs(rr) > 0) > 0 then 0 end severity
from q group by all"""))
def dem_report(spark, d):
    p = tpts(spark, d).withColumns({
        "three_sigma_edit": F.col("z") > 200, "sigma": F.col("tide_ocean")})
    return rounded(aggregate.dem_report(p, ["x0", "y0"], "dem_h"))


@query("tile_summary", "AGG-14", sql("pts tpts", """
select x0, y0, min(delta_time) first_delta_time, max(delta_time) last_delta_time, min(x) x_min,
 max(x) x_max, min(y) y_min, max(y) y_max, min(z) z_min, max(z) z_max, count(*) n
from tpts group by all"""))
def tile_summary(spark, d):
    return aggregate.data_span(tpts(spark, d), ["x0", "y0"])


@query("robust_spread", "AGG-16", sql("pts", f"""
select sid, {r('(quantile_cont(z-dem_h, 0.84)-quantile_cont(z-dem_h, 0.16))/2', 'spread')} from pts group by all"""))
def robust_spread(spark, d):
    return rounded(aggregate.robust_spread(pts(spark, d), ["sid"], F.col("z") - F.col("dem_h")))


@query("prepared_points", "FLT-2 FLT-6", sql("pts tpts", """
with s as (select * from tpts where sigma < 0.2e0),
q as (select *, floor((x-(x0-3e4))/7500) bi, floor((y-(y0-3e4))/7500) bj, z-dem_h r from s),
m as (select x0, y0, bi, bj, median(r) med from q group by all)
select x0, y0, count(*) n, count(*) filter (where abs(r-med) < 300) n_used
from q join m using (x0, y0, bi, bj) group by all"""))
def prepared_points(spark, d):
    from icegrid.plans.prepare import PointRules, prepare_points

    rules = PointRules(sigma_tol=0.2, dem_tol=300.0, min_points=1, min_span=0.0)
    out = prepare_points(pts(spark, d), rules)
    return out.groupBy("x0", "y0").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("three_sigma_edit"), 1)).alias("n_used"))


@query("reconciled_sensors", "SET-7", """
with s as (select cast(o_orderpriority as varchar) sensor, cast(o_custkey % 11 as int) file_order,
   cast(min(o_orderkey) % 5 as int) num from orders group by all),
f as (select sensor, row_number() over (order by min(file_order*1000+num), sensor) new_num from s group by sensor)
select sensor, file_order, num, cast(new_num as int) new_num from s join f using (sensor)""")
def reconciled_sensors(spark, d):
    o = table(spark, d, "orders")
    s = o.groupBy(
        F.col("o_orderpriority").alias("sensor"), (F.col("o_custkey") % 11).cast("int").alias("file_order")
    ).agg((F.min("o_orderkey") % 5).cast("int").alias("num"))
    return aggregate.reconcile_ids(s).select("sensor", "file_order", "num", "new_num")


@query("remapped_sensors", "SET-7", """
with s as (select cast(o_orderpriority as varchar) sensor, cast(o_custkey % 11 as int) file_order,
   cast(ascii(substr(o_orderpriority, 1, 1)) % 5 as int) num from orders group by all),
f as (select sensor, row_number() over (order by min(file_order*1000+num), sensor) new_num from s group by sensor)
select o_orderkey, cast(coalesce(new_num, -1) as int) new_num from
 (select o_orderkey, cast(o_custkey % 11 as int) file_order, cast(o_orderkey % 7 as int) num from orders) o
 left join (select file_order, num, new_num from s join f using (sensor)) m using (file_order, num)""")
def remapped_sensors(spark, d):
    o = table(spark, d, "orders")
    file_order = (F.col("o_custkey") % 11).cast("int").alias("file_order")
    s = o.select(
        F.col("o_orderpriority").alias("sensor"), file_order,
        (F.ascii(F.substring("o_orderpriority", 1, 1)) % 5).cast("int").alias("num"),
    ).distinct()
    data = o.select("o_orderkey", file_order, (F.col("o_orderkey") % 7).cast("int").alias("sensor_num"))
    out = aggregate.remap_ids(data, aggregate.reconcile_ids(s))
    return out.select("o_orderkey", "new_num")


@query("weighted_cells", "PRJ-5 AGG-5", sql("pts", f"""
select cast(floor(x/1e4) as int) ix, cast(floor(y/1e4) as int) iy, "cycle" it,
 {r('sum(z/(sigma*sigma))/sum(1/(sigma*sigma))', 'z')}, count(*) as "count" from pts group by 1, 2, 3"""))
def weighted_cells(spark, d):
    return rounded(aggregate.cell_means(pts(spark, d), 1e4, F.col("cycle")))
