"""Height points and grids derived from the given tables, once in Spark and once in SQL.

Parts are places, line items are measurements. Every 2000 parts fill a box of 200 km, and
boxes lie side by side, so the map grows with the data at a constant density. Values are
whole multiples of powers of two, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icegrid.session import tune

EPOCHS = (12, 39)  # quarters since 1992 that the ship dates cover


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, i = F.col, lambda v: F.rint(v * 100)
    p, ship = c("l_partkey"), c("l_shipdate")
    start = F.lit("2018-01-01").cast("timestamp_ntz")
    quarter = (F.year(ship) - 1992) * 4 + F.quarter(ship) - 1
    seconds = F.timestamp_diff("SECOND", start, ship).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("oid"), c("l_linenumber").alias("lno"), c("l_suppkey").alias("sid"),
        (c("l_suppkey") % 1387 + 1).cast("int").alias("rgt"),
        (c("l_linenumber") % 3 + 1).cast("int").alias("pair"), p.alias("ref_pt"),
        quarter.cast("int").alias("cycle"), seconds.alias("delta_time"),
        (seconds / 24 / 3600 / 365.25 + 2018).alias("time"),
        ((p * 7919) % 200000 - 100000 + 200000 * F.floor(p / 2000)).cast("double").alias("x"),
        ((p * 104729) % 200000 - 100000).cast("double").alias("y"),
        (F.floor(c("l_extendedprice") * 64 / 100) / 64).alias("z"),
        ((i(c("l_discount")) + 4) / 64).alias("sigma"),
        ((i(c("l_tax")) + 6) / 64).alias("sigma_corr"),
        (c("l_quantity") * 20).alias("dem_h"), ((p * 37) % 400).cast("double").alias("geoid_h"),
        ((i(c("l_discount")) - 5) / 1024).alias("n_slope"),
        ((i(c("l_tax")) - 4) / 1024).alias("e_slope"),
        F.when(c("l_linenumber") != 7, (c("l_linenumber") - 4) / F.lit(64.0)).alias("tide_ocean"),
        ((i(c("l_tax")) - 4) / 128).alias("dac"),
        (c("l_linenumber") % 4).cast("int").alias("fit_quality"),
        (c("l_returnflag") != "R").alias("along_track"), c("l_quantity").alias("qty"),
        (70 + (p % 1900) / F.lit(100.0)).alias("lat"),
        ((p * 7) % 360 - F.lit(179.5)).alias("lon"),
    )


PTS = """
pts as (select l_orderkey oid, l_linenumber lno, l_suppkey sid,
  cast(l_suppkey % 1387 + 1 as int) rgt, cast(l_linenumber % 3 + 1 as int) pair,
  l_partkey ref_pt,
  cast((year(l_shipdate)-1992)*4 + quarter(l_shipdate) - 1 as int) as cycle,
  cast(date_diff('second', timestamp '2018-01-01 00:00:00', l_shipdate) as double) delta_time,
  cast(date_diff('second', timestamp '2018-01-01 00:00:00', l_shipdate) as double)
    /24/3600/cast(365.25 as double)+2018 as "time",
  cast((l_partkey*7919)%200000 - 100000 + 200000*(l_partkey//2000) as double) x,
  cast((l_partkey*104729)%200000 - 100000 as double) y,
  floor(l_extendedprice*64/100)/64 z,
  (round_even(l_discount*100,0)+4)/64 sigma, (round_even(l_tax*100,0)+6)/64 sigma_corr,
  l_quantity*20 dem_h, cast((l_partkey*37)%400 as double) geoid_h,
  (round_even(l_discount*100,0)-5)/1024 n_slope, (round_even(l_tax*100,0)-4)/1024 e_slope,
  case when l_linenumber <> 7 then (l_linenumber-4)/cast(64 as double) end tide_ocean,
  (round_even(l_tax*100,0)-4)/128 dac, cast(l_linenumber % 4 as int) fit_quality,
  l_returnflag <> 'R' along_track, l_quantity qty,
  70 + (l_partkey % 1900)/cast(100 as double) lat,
  cast((l_partkey*7) % 360 as double) - 179.5 lon
  from lineitem)"""


def dz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change grid: 10 km cells by quarter. Cells whose smallest quantity is 1 have no area."""
    p = pts(spark, sf_dir)
    cells = p.withColumns({
        "ix": F.floor(F.col("x") / 1e4).cast("int"), "iy": F.floor(F.col("y") / 1e4).cast("int"),
        "it": F.col("cycle"),
    })
    out = cells.groupBy("ix", "iy", "it").agg(
        F.avg("z").alias("dz"), F.max("sigma").alias("sigma_dz"),
        ((F.min("qty") - 1) * 1e6).alias("cell_area"),
        F.count("*").cast("double").alias("count"),
        (F.max("z") - F.min("z")).alias("misfit_rms"),
        F.max("sigma_corr").alias("misfit_scaled_rms"),
    )
    return out.withColumns({
        "t": 1992 + F.col("it") / F.lit(4.0), "x": F.col("ix") * F.lit(1e4),
        "y": F.col("iy") * F.lit(1e4),
    })


DZ = """
dz as (select *, 1992 + it/cast(4 as double) t, ix*1e4 x, iy*1e4 y from (
  select cast(floor(x/1e4) as int) ix, cast(floor(y/1e4) as int) iy, "cycle" it,
   avg(z) dz, max(sigma) sigma_dz, (min(qty)-1)*1e6 cell_area,
   cast(count(*) as double) as "count", max(z)-min(z) misfit_rms,
   max(sigma_corr) misfit_scaled_rms
  from pts group by all))"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node grid of 10 km: DEM, its error, a mask, a land class and a thickness."""
    p = pts(spark, sf_dir)
    nodes = p.withColumns({
        "ix": F.rint(F.col("x") / 1e4).cast("int"), "iy": F.rint(F.col("y") / 1e4).cast("int"),
    })
    return nodes.groupBy("ix", "iy").agg(
        F.avg("dem_h").alias("v"), F.max("sigma").alias("h_sigma"),
        (F.min("lno") + F.max("lno") > 7).cast("int").alias("mask"),
        (F.count("*") % 5).cast("int").alias("class"), F.min("qty").alias("thickness"),
    ).withColumns({"x": F.col("ix") * F.lit(1e4), "y": F.col("iy") * F.lit(1e4)})


GRID = """
grid as (select *, ix*1e4 x, iy*1e4 y from (
  select cast(round_even(x/1e4,0) as int) ix, cast(round_even(y/1e4,0) as int) iy,
   avg(dem_h) v, max(sigma) h_sigma, case when min(lno)+max(lno) > 7 then 1 else 0 end mask,
   cast(count(*) % 5 as int) class, min(qty) thickness
  from pts group by all))"""


def fmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask on every cell of the 5 km lattice over the points' box: 1 where points are."""
    from icegrid.operators.interp import lattice

    p = pts(spark, sf_dir).select(
        F.floor(F.col("x") / 5e3).cast("int").alias("ix"),
        F.floor(F.col("y") / 5e3).cast("int").alias("iy"), "qty",
    )
    seen = p.groupBy("ix", "iy").agg((F.max("qty") >= 48).cast("int").alias("mask"))
    full = lattice(seen, []).join(seen, ["ix", "iy"], "left")
    return full.withColumn("mask", F.coalesce("mask", F.lit(0)))


FMASK = """
fseen as (select cast(floor(x/5e3) as int) ix, cast(floor(y/5e3) as int) iy,
   case when max(qty) >= 48 then 1 else 0 end mask from pts group by all),
fmask as (select l.ix, l.iy, coalesce(s.mask, 0) mask
  from (select unnest(range(x0, x1+1))::int ix, iy from
     (select x0, x1, unnest(range(y0, y1+1))::int iy from
       (select min(ix) x0, max(ix) x1, min(iy) y0, max(iy) y1 from fseen))) l
  left join fseen s using (ix, iy))"""


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model grid: 40 km nodes by year, with some missing values."""
    p = pts(spark, sf_dir)
    nodes = p.select(
        F.rint(F.col("x") / 4e4).cast("int").alias("ix"),
        F.rint(F.col("y") / 4e4).cast("int").alias("iy"),
        F.floor(F.col("cycle") / 4).cast("int").alias("it"), "e_slope", "qty", "dac",
    )
    out = nodes.groupBy("ix", "iy", "it").agg(
        F.avg("qty").alias("SMB_a"), F.avg("dac").alias("FAC"), F.count("*").alias("n")
    )
    ok = F.col("n") % 4 != 0
    return out.select(
        "ix", "iy", "it", F.when(ok, F.col("SMB_a")).alias("SMB_a"),
        F.when(ok, F.col("FAC")).alias("FAC"),
    )


MODEL = """
model as (select ix, iy, it, case when n%4 <> 0 then SMB_a end SMB_a,
   case when n%4 <> 0 then FAC end FAC from (
  select cast(round_even(x/4e4,0) as int) ix, cast(round_even(y/4e4,0) as int) iy,
   cast("cycle"//4 as int) it, avg(qty) SMB_a, avg(dac) FAC, count(*) n from pts group by all))"""


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of the 40 km tile lattice that hold points in their inner square."""
    p = pts(spark, sf_dir)
    return p.select(
        (F.rint(F.col("x") / 4e4) * 4e4).alias("x0"), (F.rint(F.col("y") / 4e4) * 4e4).alias("y0")
    ).distinct()


TILES = """
tiles as (select distinct round_even(x/4e4,0)*4e4 x0, round_even(y/4e4,0)*4e4 y0 from pts)"""


def tpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from icegrid.operators.tiles import assign_tiles

    return assign_tiles(pts(spark, sf_dir), 6e4, 4e4)


TPTS = """
near as (select * from (values (-1),(0),(1)) d(d)),
tpts as (select p.* exclude (cx, cy), (cx+i.d)*4e4 x0, (cy+j.d)*4e4 y0 from (select *,
     round_even(x/4e4,0) cx, round_even(y/4e4,0) cy from pts) p, near i, near j
  where abs(x-(cx+i.d)*4e4) <= 3e4 and abs(y-(cy+j.d)*4e4) <= 3e4)"""


def polys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One triangle between three places of each supplier in one box of 200 km, as edges."""
    p = pts(spark, sf_dir).withColumn("box", F.floor(F.col("ref_pt") / 2000))
    turn = F.struct((F.col("ref_pt") * 7919 + F.col("sid") * 31) % 100003, F.col("ref_pt"))
    home = p.groupBy("sid").agg(F.min_by("box", turn).alias("box"))
    p = p.join(home, ["sid", "box"])
    corner = lambda k: F.min_by(
        F.struct((F.col("x") + 0.25).alias("x"), (F.col("y") + 0.125).alias("y")),
        F.struct((F.col("ref_pt") * k) % 1009, F.col("ref_pt")),
    )
    tri = p.groupBy("sid").agg(corner(1).alias("a"), corner(17).alias("b"), corner(401).alias("c"))
    edge = lambda a, b: F.struct(
        F.col(f"{a}.x").alias("x1"), F.col(f"{a}.y").alias("y1"),
        F.col(f"{b}.x").alias("x2"), F.col(f"{b}.y").alias("y2"),
    )
    edges = F.array(edge("a", "b"), edge("b", "c"), edge("c", "a"))
    return tri.select(F.col("sid").alias("poly_id"), F.explode(edges).alias("e")).select(
        "poly_id", "e.*"
    )


POLYS = """
home as (select sid, arg_min(ref_pt // 2000, ((ref_pt*7919 + sid*31) % 100003)*100000000 + ref_pt) box from pts group by 1),
tri as (select sid poly_id,
   arg_min({'x': x+0.25, 'y': y+0.125}, ((ref_pt*1)%1009)*100000000 + ref_pt) a,
   arg_min({'x': x+0.25, 'y': y+0.125}, ((ref_pt*17)%1009)*100000000 + ref_pt) b,
   arg_min({'x': x+0.25, 'y': y+0.125}, ((ref_pt*401)%1009)*100000000 + ref_pt) c
   from pts join home using (sid) where ref_pt // 2000 = box group by 1),
polys as (select poly_id, a.x x1, a.y y1, b.x x2, b.y y2 from tri
   union all select poly_id, b.x, b.y, c.x, c.y from tri
   union all select poly_id, c.x, c.y, a.x, a.y from tri)"""

SQL_TABLES = {
    "pts": PTS, "dz": DZ, "grid": GRID, "fmask": FMASK, "model": MODEL, "tiles": TILES,
    "tpts": TPTS, "polys": POLYS,
}


def sql(names: str, body: str) -> str:
    """A statement over the named derived tables."""
    used = [n for n in SQL_TABLES if n in names.split()]
    head = ",".join(SQL_TABLES[n] for n in used)
    start = "with recursive " if body.lstrip().startswith("with recursive ") else "with "
    joiner = ",\n" if body.lstrip().startswith(start) else "\n"
    body = body.lstrip()[len(start):] if joiner == ",\n" else body
    return f"with recursive {head}{joiner}{body}" if head else body


def r(expr: str, name: str, digits: int = 6) -> str:
    """A rounded SQL column. The small shift moves exact halves off the edge of rounding;
    adding zero turns negative zero into zero."""
    return f"round({expr} + 17e-{digits + 3}, {digits}) + 0.0 as {name}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded in the same way."""
    cols = [
        (F.round(F.col(c) + float(f"17e-{digits + 3}"), digits) + 0.0).alias(c)
        if t == "double" else F.col(c)
        for c, t in df.dtypes
    ]
    return df.select(*cols)
