"""Grid lookups, polygons, masks and corrections that need a map."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import dz, fmask, grid, model, polys, pts, r, rounded, sql, table, tiles
from icegrid.operators import interp, masks, polygons
from icegrid.session import scratch_dir
from icegrid.sources import grids as grid_source


def bilinear(name: str, src: str, table_: str, field: str, spacing: str, x: str = "x", y: str = "y",
             extra: str = "") -> str:
    """CTE name: the rows of src with the bilinear value of a grid field in column v_."""
    q = lambda a, i, j: (
        f"left join {table_} {a} on {a}.ix = p.cx+{i} and {a}.iy = p.cy+{j}"
        + (f" and {a}.{extra} = p.{extra}" if extra else "")
    )
    w = {"a": "(1-fx)*(1-fy)", "b": "fx*(1-fy)", "c": "(1-fx)*fy", "d": "fx*fy"}
    v = " + ".join(f"case when {e} = 0 then 0 else {e}*{k}.{field} end" for k, e in w.items())
    return f"""{name} as (select p.* exclude (cx, cy, fx, fy), {v} v_ from
 (select *, floor({x}/{spacing}) cx, floor({y}/{spacing}) cy, {x}/{spacing}-floor({x}/{spacing}) fx,
   {y}/{spacing}-floor({y}/{spacing}) fy from {src}) p
 {q('a', 0, 0)} {q('b', 1, 0)} {q('c', 0, 1)} {q('d', 1, 1)})"""


@query("grid_at_points", "JON-1", sql("pts grid", f"""
with {bilinear('q', 'pts', 'grid', 'v', '1e4')} select oid, lno, x, y, {r('v_', 'z_ref')} from q"""))
def grid_at_points(spark, d):
    g = grid(spark, d).select("ix", "iy", "v")
    out = interp.interp2(pts(spark, d), g, {"v": "z_ref"}, 1e4)
    return rounded(out.select("oid", "lno", "x", "y", "z_ref"))


TRI = """
p3 as (select *, floor(x/4e4) cx, floor(y/4e4) cy, floor("time"-1992) ct, x/4e4-floor(x/4e4) fx,
  y/4e4-floor(y/4e4) fy, ("time"-1992)-floor("time"-1992) ft from pts),
c3 as (select p3.*, di, dj, dk, case when di=1 then fx else 1-fx end * case when dj=1 then fy else 1-fy end
  * case when dk=1 then ft else 1-ft end w from p3, (values (0,0,0),(1,0,0),(0,1,0),(1,1,0),(0,0,1),(1,0,1),(0,1,1),(1,1,1)) m(di,dj,dk)),
v3 as (select oid, lno, ref_pt, z, delta_time, qty, any_value(dac) dac, any_value(along_track) along_track, any_value(tide_ocean) tide_ocean,
  case when count(*) filter (where w > 0 and m.SMB_a is null) = 0 then sum(w*m.SMB_a) end smb,
  case when count(*) filter (where w > 0 and m.FAC is null) = 0 then sum(w*m.FAC) end fac
  from c3 left join {m} m on m.ix = cx+di and m.iy = cy+dj and m.it = ct+dk group by oid, lno, ref_pt, z, delta_time, qty, sid)"""


@query("model_at_points", "JON-2", sql("pts model", f"""
with {TRI.replace('{m}', 'model')} select oid, lno, ref_pt, z, {r('smb', 'smb')}, {r('fac', 'fac')} from v3"""))
def model_at_points(spark, d):
    out = interp.interp3(pts(spark, d), model(spark, d), {"SMB_a": "smb", "FAC": "fac"}, 4e4, 1992.0, 1.0)
    return rounded(out.select("oid", "lno", "ref_pt", "z", "smb", "fac"))


@query("regridded", "JON-3", sql("pts grid", f"""
with box as (select cast(ceil(min(ix)*2.5e0) as int) x0, cast(floor(max(ix)*2.5e0) as int) x1,
  cast(ceil(min(iy)*2.5e0) as int) y0, cast(floor(max(iy)*2.5e0) as int) y1 from grid),
n as (select unnest(range(x0, x1+1))::int ix, iy from (select x0, x1, unnest(range(y0, y1+1))::int iy from box)),
n2 as (select *, ix*4e3 x, iy*4e3 y from n),
{bilinear('q', 'n2', 'grid', 'v', '1e4')} select ix, iy, {r('v_', 'v')} from q"""))
def regridded(spark, d):
    out = interp.regrid(grid(spark, d).select("ix", "iy", "v"), ["v"], 1e4, 4e3)
    return rounded(out.select("ix", "iy", "v"))


@query("regridded_epochs", "JON-3 SRC-5", sql("pts model", f"""
with box as (select it, cast(ceil(min(ix)*1.6e0) as int) x0, cast(floor(max(ix)*1.6e0) as int) x1,
  cast(ceil(min(iy)*1.6e0) as int) y0, cast(floor(max(iy)*1.6e0) as int) y1 from model group by it),
n as (select it, unnest(range(x0, x1+1))::int ix, iy from (select it, x0, x1, unnest(range(y0, y1+1))::int iy from box)),
n2 as (select *, ix*25e3 x, iy*25e3 y from n),
{bilinear('q', 'n2', 'model', 'SMB_a', '4e4', extra='it')} select it, ix, iy, {r('v_', 'smb')} from q"""))
def regridded_epochs(spark, d):
    out = interp.regrid(model(spark, d).select("ix", "iy", "it", "SMB_a"), ["SMB_a"], 4e4, 25e3, ["it"])
    return rounded(out.select("it", "ix", "iy", F.col("SMB_a").alias("smb")))


@query("nearest_cells", "JON-4", sql("pts grid", f"""
select oid, lno, ref_pt, {r('v', 'v')} from pts left join grid
 on grid.ix = ceil(pts.x/1e4-0.5e0) and grid.iy = ceil(pts.y/1e4-0.5e0)"""))
def nearest_cells(spark, d):
    out = interp.nearest_cell(pts(spark, d), grid(spark, d), ["v"], 1e4, "x", "y")
    return rounded(out.select("oid", "lno", "ref_pt", "v"))


@query("cropped_grid", "SRC-5", sql("pts dz", """
select ix, iy, it, dz from dz where x between -60000 and 130000 and y between -50000 and 60000
 and t between 1996.2375e0 and 1999.0125e0"""))
def cropped_grid(spark, d):
    """Written as a table, then read near a box and time range."""
    path = scratch_dir(spark, "grid")
    grid_source.split_bands(dz(spark, d), path)
    out = grid_source.read_grid(
        spark, path, (-5e4, 12e4, -4e4, 5e4), 1e4, (1996.5, 1998.75), 0.25, ["dz"])
    return out.select("ix", "iy", "it", "dz")


@query("band_folders", "SNK-8", sql("pts dz", """
select t, count(*) n, count(dz) n_dz from dz group by t"""))
def band_folders(spark, d):
    path = scratch_dir(spark, "bands")
    grid_source.split_bands(dz(spark, d), path)
    return spark.read.parquet(path).groupBy(F.col("t").cast("double").alias("t")).agg(
        F.count("*").alias("n"), F.count("dz").alias("n_dz"))


@query("tide_corrected", "JON-6", sql("pts grid", f"""
with {bilinear('q', 'pts', 'grid', 'mask', '1e4').replace('v_ from', 'm_ from')},
{bilinear('s', 'q', 'grid', 'h_sigma', '1e4')},
f as (select *, coalesce(m_ > 0.5, false) fl from s),
g as (select *, case when fl then v_ else 0 end sc from f),
h as (select *, case when fl then coalesce(tide_ocean*case when sc = 0 then 1 else sc end, 0) else 0 end tc,
  case when fl then coalesce(dac*case when sc = 0 then 1 else sc end, 0) else 0 end dc from g)
select oid, lno, ref_pt, fl floating, {r('sc', 'tide_adj_scale')}, {r('z-(tc+dc)', 'z')} from h"""))
def tide_corrected(spark, d):
    g = grid(spark, d)
    scale = g.select("ix", "iy", F.col("h_sigma").alias("v"))
    out = masks.apply_tides(pts(spark, d), g.select("ix", "iy", "mask"), 1e4, scale)
    return rounded(out.select("oid", "lno", "ref_pt", "floating", "tide_adj_scale", "z"))


def filled_sql(src: str, fields: list[str], key: str = "it", missing: str = "{f} is null") -> str:
    """CTE filled: missing values of src replaced by Gaussian means (width 1) per key."""
    part = f"and b.{key} = a.{key}" if key else ""
    cols = []
    for f in fields:
        ok = f"not ({missing.format(f='b.' + f)})"
        w = "exp(-0.5e0*((a.ix-b.ix)*(a.ix-b.ix)+(a.iy-b.iy)*(a.iy-b.iy)))"
        mean = (f"(select sum({w}*b.{f})/nullif(sum({w}),0) from {src} b where {ok} {part}"
                f" and abs(a.ix-b.ix) <= 4 and abs(a.iy-b.iy) <= 4)")
        bad = missing.format(f="a." + f)
        cols.append(f"case when {bad} then coalesce({mean}, a.{f}) else a.{f} end {f}")
    keep = f"a.ix, a.iy{', a.' + key if key else ''}"
    return f"filled as (select {keep}, {', '.join(cols)} from {src} a)"


@query("firn_corrected", "JON-7 RAS-5", sql("pts model", f"""
with {filled_sql('model', ['SMB_a', 'FAC'])}, {TRI.replace('{m}', 'filled')},
h as (select *, fac + case when along_track then 1 else (1.02e0-0.917e0)/1.02e0 end * smb h from v3)
select oid, lno, ref_pt, {r('h', 'h_firn')}, {r('z+coalesce(tide_ocean,0)-h', 'z')} from h where h is not null"""))
def firn_corrected(spark, d):
    p = pts(spark, d).withColumns({"h_firn": F.col("tide_ocean"), "floating": ~F.col("along_track")})
    out = masks.firn_correction(
        p, model(spark, d), 4e4, 1992.0, 1.0, rho_water=1.02, subset_valid=True)
    return rounded(out.select("oid", "lno", "ref_pt", "h_firn", "z"))


@query("gaps_filled", "RAS-5", sql("pts model", f"""
with {filled_sql('model', ['SMB_a'])} select ix, iy, it, {r('SMB_a', 'smb')} from filled"""))
def gaps_filled(spark, d):
    from icegrid.operators.raster import fill_gaps

    out = fill_gaps(model(spark, d), ["SMB_a"], 1.0, ["it"])
    return rounded(out.select("ix", "iy", "it", F.col("SMB_a").alias("smb")))


@query("edges_filled", "RAS-6", sql("pts grid", f"""
with s as (select ix, iy, case when class > 0 then h_sigma else 0 end s from grid),
{filled_sql('s', ['s'], '', 'coalesce({f},0)=0')} select ix, iy, {r('s', 's')} from filled"""))
def edges_filled(spark, d):
    from icegrid.operators.raster import fill_edges

    s = grid(spark, d).select("ix", "iy", F.when(F.col("class") > 0, F.col("h_sigma")).otherwise(0.0).alias("s"))
    return rounded(fill_edges(s, "s").select("ix", "iy", "s"))


INSIDE = """
cand as (select poly_id, cast(unnest(range(cast(floor(x0/5e3) as int), cast(ceil(x1/5e3) as int)+1)) as int) ix, iy from
  (select *, unnest(range(cast(floor(y0/5e3) as int), cast(ceil(y1/5e3) as int)+1))::int iy from
   (select poly_id, min(x1) x0, max(x1) x1, min(y1) y0, max(y1) y1 from polys group by 1))),
inside as (select c.poly_id, ix, iy from cand c join polys e on e.poly_id = c.poly_id
  and (e.y1 > c.iy*5e3) <> (e.y2 > c.iy*5e3)
  and e.x1 + (c.iy*5e3-e.y1)*(e.x2-e.x1)/(e.y2-e.y1) <= c.ix*5e3
  group by all having count(*) % 2 = 1)"""


@query("polygon_cells", "JON-10", sql("pts polys", f"""
with {INSIDE} select poly_id, ix, iy from inside"""))
def polygon_cells(spark, d):
    return polygons.rasterize(polys(spark, d), 5e3, ["poly_id"]).select("poly_id", "ix", "iy")


@query("polygon_mask", "JON-10", sql("pts fmask polys", f"""
with {INSIDE}
select ix, iy, case when (ix, iy) in (select (ix, iy) from inside) then 1 else 0 end mask from fmask"""))
def polygon_mask(spark, d):
    return polygons.polygon_mask(polys(spark, d), fmask(spark, d).select("ix", "iy"), 5e3)


# the closed square meets a segment: boxes overlap and the corners lie on both sides of its line
TOUCHED = """
touched as (select distinct c.poly_id, c.ix, c.iy from
 (select poly_id, cast(unnest(range(cast(floor(x0/5e3) as int)-1, cast(ceil(x1/5e3) as int)+2)) as int) ix, iy from
  (select *, unnest(range(cast(floor(y0/5e3) as int)-1, cast(ceil(y1/5e3) as int)+2))::int iy from
   (select poly_id, min(x1) x0, max(x1) x1, min(y1) y0, max(y1) y1 from polys group by 1))) c
 join polys e on e.poly_id = c.poly_id
  and least(e.x1,e.x2) <= c.ix*5e3+2500 and greatest(e.x1,e.x2) >= c.ix*5e3-2500
  and least(e.y1,e.y2) <= c.iy*5e3+2500 and greatest(e.y1,e.y2) >= c.iy*5e3-2500
 where abs(sign((e.x2-e.x1)*(c.iy*5e3-2500-e.y1)-(e.y2-e.y1)*(c.ix*5e3-2500-e.x1))
  + sign((e.x2-e.x1)*(c.iy*5e3-2500-e.y1)-(e.y2-e.y1)*(c.ix*5e3+2500-e.x1))
  + sign((e.x2-e.x1)*(c.iy*5e3+2500-e.y1)-(e.y2-e.y1)*(c.ix*5e3-2500-e.x1))
  + sign((e.x2-e.x1)*(c.iy*5e3+2500-e.y1)-(e.y2-e.y1)*(c.ix*5e3+2500-e.x1))) < 4)"""


@query("polygon_touched_cells", "JON-11", sql("pts polys", f"""
with {INSIDE}, {TOUCHED} select poly_id, ix, iy from inside union select poly_id, ix, iy from touched"""))
def polygon_touched_cells(spark, d):
    return polygons.rasterize_touched(polys(spark, d), 5e3, ["poly_id"]).select("poly_id", "ix", "iy")


@query("burnt_polygons", "JON-12", sql("pts fmask polys", f"""
with {INSIDE}, b as (select ix, iy, arg_max(cast(poly_id % 2 as int), (poly_id % 2)*1000000 + poly_id) v
  from inside group by all)
select ix, iy, coalesce(v, mask) mask from fmask left join b using (ix, iy)"""))
def burnt_polygons(spark, d):
    """All polygons that subtract, then all that add."""
    p = polys(spark, d).withColumns({
        "burn_value": (F.col("poly_id") % 2).cast("int"), "burn_order": (F.col("poly_id") % 2).cast("int")})
    return polygons.burn(fmask(spark, d), p, 5e3).select("ix", "iy", "mask")


@query("asof_versions", "JON-13", sql("pts dz", """
with v as (select distinct floor("time"*2/3)*1.5e0 version_t from pts),
b as (select distinct t from dz)
select t, coalesce((select max(version_t) from v where version_t < t), (select min(version_t) from v)) version_t from b"""))
def asof_versions(spark, d):
    v = pts(spark, d).select((F.floor(F.col("time") * 2 / 3) * F.lit(1.5)).alias("version_t")).distinct()
    return polygons.asof_before(dz(spark, d).select("t").distinct(), v)


@query("matching_bands", "JON-14 SET-4", sql("pts dz", """
with a as (select t, row_number() over (order by t) band_a from (select distinct t from dz where cell_area > 2e7)),
b as (select t, row_number() over (order by t) band_b from (select distinct t from dz where "count" > 12))
select t, cast(band_a as int) band_a, cast(band_b as int) band_b from a join b using (t)"""))
def matching_bands(spark, d):
    from pyspark.sql import Window

    def bands(df):
        times = df.select("t").distinct()
        return times.withColumn("band", F.row_number().over(Window.orderBy("t")))

    g = dz(spark, d)
    return masks.matching_bands(bands(g.where("cell_area > 2e7")), bands(g.where("count > 12")))


@query("series_at_places", "JON-15", sql("pts dz tiles", f"""
with pl as (select x0+2500 x, y0+5000 y from tiles),
c as (select pl.*, cast(floor(x/1e4) as int)+i ix, cast(floor(y/1e4) as int)+j iy,
  case when i=1 then x/1e4-floor(x/1e4) else 1-(x/1e4-floor(x/1e4)) end
  * case when j=1 then y/1e4-floor(y/1e4) else 1-(y/1e4-floor(y/1e4)) end w
  from pl, (values (0,0),(1,0),(0,1),(1,1)) m(i,j))
select c.x, c.y, it, {r('sum(w*dz)', 'dz')} from c join dz on dz.ix = c.ix and dz.iy = c.iy
where w > 0 group by c.x, c.y, it having sum(w) > 1-1e-9"""))
def series_at_places(spark, d):
    at = tiles(spark, d).select(
        (F.col("x0") + 2500).alias("x"), (F.col("y0") + 5000).alias("y"))
    return rounded(interp.series_at(at, dz(spark, d), ["dz"], 1e4).select("x", "y", "it", "dz"))


@query("one_epoch", "JON-15", sql("pts dz", "select ix, iy, dz from dz where it = 24"))
def one_epoch(spark, d):
    return interp.slice_epoch(dz(spark, d), 24).select("ix", "iy", "dz")


@query("rock_removed", "JON-16", sql("pts dz grid", f"""
with rk as (select ix, iy, case when class = 3 then 1e0 else 0e0 end rk from grid),
c as (select distinct ix, iy, ix*75e2 x, iy*75e2 y from dz),
{bilinear('q', 'c', 'rk', 'rk', '1e4')}
select dz.ix, dz.iy, it, case when v_ > 0.5 then 0 when cell_area > 0 then 1 else 0 end mask
from dz join q using (ix, iy)"""))
def rock_removed(spark, d):
    m = dz(spark, d).select("ix", "iy", "it", (F.col("cell_area") > 0).cast("int").alias("mask"))
    return masks.apply_rock(m, grid(spark, d).select("ix", "iy", "class"), 7.5e3, 1e4, 3)


@query("geoid_at_cells", "JON-17 PRJ-13", sql("pts grid", f"""
with gd as (select cast(round_even(((l2 % 360)+360)%360/10, 0) as int) ix, cast(round_even(lat/10, 0) as int) iy, avg(geoid_h) geoid_h
  from (select *, lon l2 from pts) group by 1, 2),
c as (select ix, iy, 72+((ix % 15)+15) % 15 lat, cast(((iy*13 % 360)+360)%360 as double) lon from grid),
{bilinear('q', 'c', 'gd', 'geoid_h', '1', 'lon/10e0', 'lat/10e0')}
select ix, iy, {r('v_+(-0.198e0*(0.5e0*(3*sin(radians(lat))*sin(radians(lat))-1))*1.3e0)', 'geoid_z')} from q"""))
def geoid_at_cells(spark, d):
    lon = F.pmod(F.col("lon"), F.lit(360.0))
    geoid = pts(spark, d).groupBy(
        F.rint(lon / 10).cast("int").alias("ix"), F.rint(F.col("lat") / 10).cast("int").alias("iy")
    ).agg(F.avg("geoid_h").alias("geoid_h"))
    lat = (72 + F.pmod(F.col("ix"), F.lit(15))).cast("double")
    out = masks.geoid_on_cells(grid(spark, d).select("ix", "iy"), geoid, 10.0, lat, F.col("iy") * 13.0)
    return rounded(out.select("ix", "iy", "geoid_z"))


Z0_GEOID = "z0g as (select ix, iy, v z0, thickness*8 geoid_z, mask from grid)"


def z0_geoid(spark, d):
    return grid(spark, d).select(
        "ix", "iy", F.col("v").alias("z0"), (F.col("thickness") * 8).alias("geoid_z"), "mask")


@query("surface_mask_by_geoid", "JON-17", sql("pts grid", f"""
with {Z0_GEOID} select ix, iy, case when z0 < geoid_z+300 then 0 else mask end mask from z0g"""))
def surface_mask_by_geoid(spark, d):
    z0 = z0_geoid(spark, d).withColumn("geoid_z", F.col("geoid_z") + 300)
    g = dz(spark, d).withColumn("mask", F.lit(1))
    return masks.mask_below_geoid(z0, g, 1e4, 1e4)[0].select("ix", "iy", "mask")


@query("change_mask_by_geoid", "JON-17", sql("pts dz grid", f"""
with {Z0_GEOID}, c as (select distinct ix, iy, ix*75e2 x, iy*75e2 y from dz),
{bilinear('q', 'c', 'z0g', 'z0', '1e4').replace('v_ from', 'a_ from')},
{bilinear('q2', 'q', 'z0g', 'geoid_z', '1e4')}
select dz.ix, dz.iy, it, case when a_+dz-700 > v_ then 1 else 0 end mask,
  case when a_+dz-700 > v_ then cell_area else 0 end cell_area from dz join q2 using (ix, iy)"""))
def change_mask_by_geoid(spark, d):
    g = dz(spark, d).withColumns({"mask": F.lit(1), "dz": F.col("dz") - 700})
    return masks.mask_below_geoid(z0_geoid(spark, d), g, 1e4, 7.5e3)[1].select(
        "ix", "iy", "it", "mask", "cell_area")


@query("nation_rings", "AGG-12 JON-10", """
with v as (select s_nationkey, s_suppkey // 250 ring,
   cast((s_suppkey*37) % 360 - 180 as double) lon, 60 + (s_suppkey*11 % 300)/10e0 lat from supplier)
select s_nationkey, ring, min(lon) filter (where abs(lat) <= 88) lon_min, max(lon) filter (where abs(lat) <= 88) lon_max,
  min(lat) lat_min, max(lat) lat_max, count(*) n_edges from v group by all""")
def nation_rings(spark, d):
    """Extent and number of edges of rings of up to 250 suppliers of a nation, from lists."""
    from icegrid.operators.aggregate import polygon_bounds

    s = table(spark, d, "supplier").withColumn("p", F.array(
        ((F.col("s_suppkey") * 37) % 360 - 180).cast("double"), 60 + (F.col("s_suppkey") * 11 % 300) / F.lit(10.0)))
    keys = ["s_nationkey", "ring"]
    s = s.withColumn("ring", F.floor(F.col("s_suppkey") / 250))
    rings = s.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", "p"))), lambda e: e["p"]).alias("points"))
    v = polygons.ring_vertices(rings, "points", keys)
    edges = polygons.polygon_edges(
        v.withColumnsRenamed({"lon": "x", "lat": "y"}), keys)
    n = edges.groupBy(*keys).agg(F.count("*").alias("n_edges"))
    return polygon_bounds(v, keys).join(n, keys)
