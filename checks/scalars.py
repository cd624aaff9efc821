"""Scalar expressions, names, times and product values."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import dz, grid, model, pts, r, rounded, sql, table, tiles
from icegrid import functions as fn
from icegrid.operators import products

# WGS84 constants of the projection for the SQL side, as decimal text
A, E_, E2 = "6378137e0", "0.08181919084262149e0", "0.006694379990141317e0"


def _rho(hemi: int) -> str:
    ts = {1: "radians(70e0)", -1: "radians(71e0)"}[hemi]
    m = f"(cos({ts})/sqrt(1-{E2}*sin({ts})*sin({ts})))"
    return f"({A}*{m}/{_t(ts)})"


def _t(phi: str) -> str:
    return (f"(tan(pi()/4-({phi})/2)/pow((1-{E_}*sin({phi}))/(1+{E_}*sin({phi})),{E_}/2))")


def xy_sql(lat: str, lon: str, hemi: int) -> tuple[str, str]:
    lon0 = {1: -45, -1: 0}[hemi]
    rho = f"{_rho(hemi)}*{_t(f'radians(({lat})*{hemi})')}"
    return (f"{rho}*sin(radians(({lon})-({lon0})))",
            f"{-hemi}*{rho}*cos(radians(({lon})-({lon0})))")


def latlon_sql(x: str, y: str, hemi: int) -> tuple[str, str]:
    chi = f"(pi()/2-2*atan(sqrt(({x})*({x})+({y})*({y}))/{_rho(hemi)}))"
    e2 = float(E2.rstrip("e0"))
    c = [e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360,
         7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
         7 * e2**3 / 120 + 81 * e2**4 / 1120, 4279 * e2**4 / 161280]
    phi = "+".join([chi, *[f"{v:.18e}*sin({2 * k}*{chi})" for k, v in enumerate(c, 1)]])
    lon = f"(degrees(atan2({x},{-hemi}*({y})))+({ {1: -45, -1: 0}[hemi] }))"
    lon = f"case when {lon}>180 then {lon}-360 when {lon}<=-180 then {lon}+360 else {lon} end"
    return f"degrees({phi})*{hemi}", lon


def scale_sql(lat: str, hemi: int) -> str:
    p = f"radians(({lat})*{hemi})"
    return f"({_rho(hemi)}/{A}*{_t(p)}/(cos({p})/sqrt(1-{E2}*sin({p})*sin({p}))))"


_nx, _ny = xy_sql("lat", "lon", 1)
_sx, _sy = xy_sql("-lat", "lon", -1)


@query("polar_xy", "PRJ-1", sql("pts", f"""
select ref_pt, {r(_nx, 'xn', 4)}, {r(_ny, 'yn', 4)}, {r(_sx, 'xs', 4)}, {r(_sy, 'ys', 4)}
from pts"""))
def polar_xy(spark, d):
    p = pts(spark, d)
    xn, yn = fn.polar_xy(F.col("lat"), F.col("lon"), 1)
    xs, ys = fn.polar_xy(-F.col("lat"), F.col("lon"), -1)
    return rounded(p.select("ref_pt", xn.alias("xn"), yn.alias("yn"), xs.alias("xs"), ys.alias("ys")), 4)


_nlat, _nlon = latlon_sql("x*10", "y*10", 1)
_slat, _slon = latlon_sql("x*10", "y*10", -1)


@query("polar_latlon", "PRJ-2", sql("pts", f"""
select ref_pt, {r(_nlat, 'lat_n')}, {r(_nlon, 'lon_n')}, {r(_slat, 'lat_s')}, {r(_slon, 'lon_s')}
from pts"""))
def polar_latlon(spark, d):
    p = pts(spark, d)
    a, b = fn.polar_latlon(F.col("x") * 10, F.col("y") * 10, 1)
    e, f = fn.polar_latlon(F.col("x") * 10, F.col("y") * 10, -1)
    return rounded(p.select("ref_pt", a.alias("lat_n"), b.alias("lon_n"), e.alias("lat_s"), f.alias("lon_s")))


@query("cell_area", "PRJ-3", sql("pts grid", f"""
select ix, iy, {r(f"1e8/({scale_sql('60+abs(iy)%25', 1)}*{scale_sql('60+abs(iy)%25', 1)})*mask", 'area', 2)}
from grid"""))
def cell_area(spark, d):
    lat = 60 + F.abs(F.col("iy")) % 25
    area = fn.cell_area(lat.cast("double"), 1e4, 1) * F.col("mask")
    return rounded(grid(spark, d).select("ix", "iy", area.alias("area")), 2)


@query("track_times", "PRJ-4", """
select l_orderkey, l_linenumber,
  round(s/24/3600/cast(365.25 as double)+2018 + 17e-9, 6)+0.0 as year,
  round(s/86400 + 17e-9, 6)+0.0 as days,
  round_even((s/24/3600/cast(365.25 as double)+2018)/0.25e0, 0)*0.25e0 as quarter_year,
  round(date_diff('day', date '2018-01-01', cast(l_shipdate as date))/365.25e0+2018 + 17e-9, 6)+0.0
    as date_year,
  round(s/31557600+2018 + 17e-9, 6)+0.0 as stamp_year
from (select l_orderkey, l_linenumber, l_shipdate,
  cast(date_diff('second', timestamp '2018-01-01 00:00:00', l_shipdate) as double) s
  from lineitem)""")
def track_times(spark, d):
    li = table(spark, d, "lineitem")
    start = F.lit("2018-01-01").cast("timestamp_ntz")
    s = F.timestamp_diff("SECOND", start, F.col("l_shipdate")).cast("double")
    year = fn.decimal_year(s)
    eight = F.date_format("l_shipdate", "yyyyMMdd")
    there_and_back = fn.year_of_timestamp(fn.timestamp_of_year(fn.year_of_timestamp(F.col("l_shipdate"))))
    return rounded(li.select(
        "l_orderkey", "l_linenumber", year.alias("year"), fn.days_since_2018(year).alias("days"),
        fn.nominal_quarter(year).alias("quarter_year"),
        fn.date_decimal_year(eight).alias("date_year"), there_and_back.alias("stamp_year"),
    ))


@query("grid_bins", "PRJ-5", sql("pts", """
select cast(round_even((x-2500)/5000,0) as int) bi, cast(round_even((y-2500)/5000,0) as int) bj,
  round_even((x-5000)/1e4,0)*1e4+5000 cx, count(*) n, min(z) z_min
from pts group by all"""))
def grid_bins(spark, d):
    return pts(spark, d).groupBy(
        fn.bin_index(F.col("x"), 5e3, 2.5e3).alias("bi"),
        fn.bin_index(F.col("y"), 5e3, 2.5e3).alias("bj"),
        fn.bin_centre(F.col("x"), 1e4).alias("cx"),
    ).agg(F.count("*").alias("n"), F.min("z").alias("z_min"))


@query("parent_tiles", "PRJ-6 SET-2", sql("pts tiles", """
select distinct floor(x0/2e5)*2e5+1e5 x0, floor(y0/2e5)*2e5+1e5 y0 from tiles"""))
def parent_tiles(spark, d):
    from icegrid.operators.filters import parent_tiles as op

    return op(tiles(spark, d))


@query("tile_names", "PRJ-7 SET-6", sql("pts tiles", """
select x0, y0, printf('E%d_N%d.h5', cast(trunc(x0/1000) as bigint), cast(trunc(y0/1000) as bigint)) as name,
  cast(regexp_extract('prelim/'||printf('E%d_N%d.h5', cast(trunc(x0/1000) as bigint), cast(trunc(y0/1000) as bigint)),
   'E(.*)_N(.*)\\.h5', 1) as double)*1000 px,
  cast(regexp_extract('prelim/'||printf('E%d_N%d.h5', cast(trunc(x0/1000) as bigint), cast(trunc(y0/1000) as bigint)),
   'E(.*)_N(.*)\\.h5', 2) as double)*1000 py
from (select distinct x x0, y y0 from pts)"""))
def tile_names(spark, d):
    t = pts(spark, d).select(F.col("x").alias("x0"), F.col("y").alias("y0")).distinct()
    t = t.withColumn("name", fn.tile_name(F.col("x0"), F.col("y0")))
    px, py = fn.parse_tile_name(F.concat(F.lit("prelim/"), "name"))
    return t.select("x0", "y0", "name", px.alias("px"), py.alias("py"))


@query("tiles_from_names", "SET-6", sql("pts tiles", """
select distinct trunc(x0/1000)*1000 x0, trunc(y0/1000)*1000 y0 from
  (select x x0, y y0 from pts)"""))
def tiles_from_names(spark, d):
    from icegrid.operators.tiles import tiles_from_names as op

    return op(pts(spark, d).select(fn.tile_name(F.col("x"), F.col("y")).alias("name")))


@query("tiles_from_commands", "SET-6", sql("pts", "select distinct x x0, y y0 from pts"))
def tiles_from_commands(spark, d):
    from icegrid.operators.tiles import tiles_from_commands as op

    line = F.format_string("fit --xy0 %d %d --prelim; echo COMPLETE", F.col("x").cast("long"), F.col("y").cast("long"))
    return op(pts(spark, d).select(line.alias("line")))


@query("masked_by_area", "PRJ-8", sql("pts dz", """
select ix, iy, it, case when cell_area <> 0 then dz end dz,
  case when cell_area <> 0 then sigma_dz end sigma_dz,
  case when cell_area <> 0 then cell_area end cell_area, "count" from dz"""))
def masked_by_area(spark, d):
    out = products.mask_by_area(dz(spark, d), ["dz", "sigma_dz"], "cell_area")
    return out.select("ix", "iy", "it", "dz", "sigma_dz", "cell_area", "count")


@query("fill_and_round", "PRJ-9 PRJ-10", sql("pts model", """
select ix, iy, it, coalesce(SMB_a, 1.7976931348623157e308) smb,
  cast(coalesce(n, 2147483647) as int) n,
  round_even(FAC*16384,0)/16384+0.0 fac4,
  case when abs(coalesce(SMB_a, 3.4e38)) <= 1e16 then SMB_a end back
from (select *, case when SMB_a > 20 then 1 end n from model)"""))
def fill_and_round(spark, d):
    m = model(spark, d).withColumn("n", F.when(F.col("SMB_a") > 20, 1))
    stored = fn.fill_value(F.col("SMB_a"), "float").cast("double")
    back = F.when(fn.unfill(stored).isNotNull(), F.col("SMB_a"))
    return m.select(
        "ix", "iy", "it", fn.fill_value(F.col("SMB_a"), "double").alias("smb"),
        fn.fill_value(F.col("n"), "int").alias("n"), (fn.quantize(F.col("FAC"), 4) + 0.0).alias("fac4"),
        back.alias("back"),
    )


@query("sigma_corr", "PRJ-11 AGG-3", sql("pts", f"""
select oid, p.rgt, p.pair, ref_pt, {r('sqrt((6.5e0*abs(n))*(6.5e0*abs(n))+(6.5e0*abs(e))*(6.5e0*abs(e))+0.0009e0)', 'sigma_corr')}
from pts p join (select rgt, pair, median(n_slope) n, median(e_slope) e from pts group by all) m
  on p.rgt = m.rgt and p.pair = m.pair"""))
def sigma_corr(spark, d):
    from icegrid.operators.points import with_sigma_corr

    out = with_sigma_corr(pts(spark, d), ["rgt", "pair"])
    return rounded(out.select("oid", "rgt", "pair", "ref_pt", "sigma_corr"))


@query("global_ref_pt", "PRJ-12", sql("pts", """
select oid, lno, ref_pt + 2006500e0*rgt g from pts"""))
def global_ref_pt(spark, d):
    return pts(spark, d).select("oid", "lno", fn.global_ref_pt(F.col("ref_pt"), F.col("rgt")).alias("g"))


@query("geoid_mean_tide", "PRJ-13", sql("pts", f"""
select oid, lno, {r('geoid_h+(-0.198e0*(0.5e0*(3*sin(radians(lat))*sin(radians(lat))-1))*1.3e0)', 'g')}
from pts"""))
def geoid_mean_tide(spark, d):
    g = fn.geoid_mean_tide(F.col("lat"), F.col("geoid_h"))
    return rounded(pts(spark, d).select("oid", "lno", g.alias("g")))


@query("firn_heights", "PRJ-14 PRJ-15", sql("pts", f"""
select oid, lno, {r('h', 'h_firn')}, {r('z+coalesce(tide_ocean,0)-h', 'z')}, {r('qty+dac', 'h_all')} from (
 select *, (qty - dac) + case when along_track then 1 else (1.02e0-0.917e0)/1.02e0 end * dac h from pts)"""))
def firn_heights(spark, d):
    p = pts(spark, d)
    h = fn.firn_height(F.col("dac"), None, F.col("qty"), ~F.col("along_track"), 1.02)
    return rounded(p.select(
        "oid", "lno", h.alias("h_firn"), fn.recorrect(F.col("z"), h, F.col("tide_ocean")).alias("z"),
        fn.firn_height(F.col("dac"), F.col("qty")).alias("h_all"),
    ))


@query("clamped_parameter", "PRJ-16", sql("pts model", f"""
select ix, iy, it, {r('case when FAC is null then 1e-2 else least(greatest(FAC, 1e-4), 1e-2) end', 'e')} from model"""))
def clamped_parameter(spark, d):
    return rounded(model(spark, d).select("ix", "iy", "it", fn.clamp_param(F.col("FAC")).alias("e")))


NAMES = """
names as (select distinct case when o_orderkey % 3 = 0
  then printf('XYZ11xo_AA_E%d_N%d_c%02d_006_01.h5', o_custkey, o_custkey % 7, o_orderkey % 20 + 1)
  when o_orderkey % 3 = 1
  then printf('XYZ11_%04d%02d_%02d%02d_006_%02d.h5', o_custkey % 1387 + 1, o_orderkey % 14 + 1, 3, o_orderkey % 17 + 3, o_orderkey % 3 + 1)
  else printf('other_%d.txt', o_custkey) end as file from orders)"""


def names(spark, d):
    o = table(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    xo = F.format_string("XYZ11xo_AA_E%d_N%d_c%02d_006_01.h5", c, c % 7, k % 20 + 1)
    at = F.format_string("XYZ11_%04d%02d_%02d%02d_006_%02d.h5", c % 1387 + 1, k % 14 + 1, F.lit(3), k % 17 + 3, k % 3 + 1)
    other = F.format_string("other_%d.txt", c)
    return o.select(F.when(k % 3 == 0, xo).when(k % 3 == 1, at).otherwise(other).alias("file")).distinct()


@query("granule_names", "PRJ-18", f"""
with {NAMES}
select file, case when t then substr(file,1,5) when x then substr(file,1,7) end short_name,
 case when t then substr(file,7,4) end start_rgt, case when t then substr(file,11,2) end start_region,
 case when t then substr(file,14,2) when x then c end start_cycle,
 case when t then substr(file,16,2) when x then c end end_cycle,
 case when t or x then '006' end as release,
 case when t then substr(file,23,2) when x then '01' end as "version"
from (select file, file like 'XYZ11\\_%' escape '\\' t, file like 'XYZ11xo\\_%' escape '\\' x,
   regexp_extract(file, '_c(..)_', 1) c from names)""")
def granule_names(spark, d):
    n = names(spark, d)
    return n.select("file", *[c.alias(k) for k, c in fn.parse_granule_name(F.col("file")).items()])
