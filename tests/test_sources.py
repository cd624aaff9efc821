"""Tables on disk: bins, fits, bands, logs, polygons."""

import json

import pytest
from pyspark.sql import functions as F

from icegrid.operators import polygons
from icegrid.operators.interp import crop_grid
from icegrid.session import cut_lineage, scratch_dir
from icegrid.sources import fits, grids, logs, points


@pytest.fixture
def cloud(spark):
    return spark.range(4000).select(
        F.col("id"), ((F.col("id") * 7919) % 900000 - 450000).cast("double").alias("x"),
        ((F.col("id") * 104729) % 900000 - 450000).cast("double").alias("y"),
    )


def test_box_reads_prune_folders(spark, cloud, tmp_path):
    path = str(tmp_path / "points")
    points.write_binned(cloud, path)
    box = (-100000.0, 90000.0, 0.0, 100000.0)
    got = points.read_points(spark, path, box, ["id", "x"], with_file=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bx" in plan.replace("PartitionFilters: [isnotnull(by_", "PartitionFilters: [isnotnull(bx")
    assert "PushedFilters: [IsNotNull(x)" in plan or "PushedFilters: [IsNotNull(y)" in plan
    want = cloud.where("x between -100000 and 90000 and y between 0 and 100000")
    assert {r.id for r in got.collect()} == {r.id for r in want.collect()}
    files = {r.input_file.split("points/")[1].rsplit("/", 1)[0] for r in got.collect()}
    assert files <= {"bx=-1/by_=0", "bx=0/by_=0"}


def test_tiles_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "fits")
    one = spark.createDataFrame([(0.0, 0.0, 1, 1.0), (4e4, 0.0, 1, 1.0)], "x0 double, y0 double, ix int, z0 double")
    fits.write_fit({"z0": one}, path)
    fits.write_fit({"z0": one.where("x0 = 0").withColumn("z0", F.lit(2.0))}, path)
    got = sorted((r.x0, r.z0) for r in fits.read_fit(spark, path, "z0").collect())
    assert got == [(0.0, 2.0), (40000.0, 1.0)]
    assert fits.read_fit(spark, path, "z0", (4e4, 0.0)).count() == 1


def test_tiles_share_folders(spark, tmp_path):
    path = str(tmp_path / "fits")
    cells = spark.range(100).select(
        (F.floor(F.col("id") / 10) * 4e4).alias("x0"), (F.col("id") % 10 * 4e4).alias("y0"), F.col("id").alias("ix"))
    fits.write_fit({"z0": cells}, path)
    assert sum(1 for _ in (tmp_path / "fits" / "z0").rglob("*.parquet")) == 1
    assert [r.ix for r in fits.read_fit(spark, path, "z0", (12e4, 8e4)).collect()] == [32]
    plan = fits.read_fit(spark, path, "z0", (12e4, 8e4))._jdf.queryExecution().executedPlan().toString()
    assert "x_block#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    fits.write_fit({"z0": cells.where("ix in (0, 32)").withColumn("ix", -F.col("ix") - 1)}, path)
    got = sorted(r.ix for r in fits.read_fit(spark, path, "z0").collect())
    assert got == [-33, -1, *[i for i in range(100) if i not in (0, 32)]]


def test_errors_are_added_and_updated(spark, tmp_path):
    path = str(tmp_path / "fits")
    cells = spark.createDataFrame([(0.0, 0.0, i, float(i)) for i in range(4)], "x0 double, y0 double, ix int, s double")
    fits.write_errors(cells, path, "z0", ["ix"], ["s"])
    fits.write_errors(cells.where("ix < 2").withColumn("s", F.col("s") + 10), path, "z0", ["ix"], ["s"])
    got = sorted((r.ix, r.s) for r in fits.read_fit(spark, path, "z0_sigma").collect())
    assert got == [(0, 10.0), (1, 11.0), (2, 2.0), (3, 3.0)]


def test_grid_crop_pads_space_and_time(spark, tmp_path):
    g = spark.range(10).select(F.col("id").cast("int").alias("ix"), F.lit(0).alias("iy"), (F.col("id") * 10.0).alias("x"), F.lit(0.0).alias("y"), (2000 + F.col("id") * 0.25).alias("t"), F.col("id").alias("v"))
    grids.split_bands(g, str(tmp_path / "g"))
    got = grids.read_grid(spark, str(tmp_path / "g"), (20.0, 50.0, 0.0, 0.0), 20.0, (2001.0, 2001.2), 0.25, ["v"])
    assert sorted(r.v for r in got.collect()) == [3, 4, 5]
    assert crop_grid(g, (20.0, 50.0, 0.0, 0.0)).count() == 4


def test_logs(spark, tmp_path):
    text = {
        "run_dh.637_12.log": "start\nworking on /x/E480_N-1360.h5\nworking on /x/E1_N1.h5\nMemory Used by job: 12K\nMemory Used by job: 99K\ndone with /x/E480_N-1360.h5\n",
        "run_dh.637_13.log": "working on /x/E40_N80.h5\nslurm memory limit (456\nError here\nprocess Killed\n",
        "run_dh.637_14.log": "some ERROR\n",
        "run_dh.637_15.log": "nothing\n",
    }
    for name, body in text.items():
        (tmp_path / name).write_text(body)
    got = {r.job: r for r in logs.log_report(logs.read_logs(spark, str(tmp_path / "*.log"))).collect()}
    assert (got["12"].x_km, got["12"].y_km, got["12"].memory_used_k, got["12"].state) == (480, -1360, 99, "complete")
    assert (got["13"].memory_limit_k, got["13"].state) == (456, "killed")
    assert got["14"].state == "error" and got["14"].x_km is None
    assert got["15"].state == "not run"


def test_polygons_from_json(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"XX_poly": [[0.0, 70.0], [10.0, 70.0], [10.0, 89.0], [300.0, 89.5]]}))
    df = spark.read.option("multiLine", True).json(str(tmp_path / "r.json")).withColumn("region", F.lit("XX"))
    v = polygons.ring_vertices(df, "XX_poly", ["region"])
    from icegrid.operators.aggregate import polygon_bounds

    assert tuple(polygon_bounds(v, ["region"]).first()) == ("XX", 0.0, 10.0, 70.0, 89.5)
    edges = polygons.polygon_edges(v.withColumnsRenamed({"lon": "x", "lat": "y"}), ["region"])
    assert edges.count() == 4


def test_lineage_is_cut_in_the_shared_folder(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "a").startswith(shared)
    df = cut_lineage(spark.range(10).where("id > 3"))
    assert df.count() == 6
    assert shared in spark.sparkContext.getCheckpointDir()


def test_parts_are_dealt_by_a_shuffle(spark):
    # one task must not run many parts of a join one after the other
    assert cut_lineage(spark.range(0, 10, 1, 2), 5).rdd.getNumPartitions() == 5


def test_a_job_leaves_no_shuffle_behind(spark):
    import time

    # no task has less than its files, so an empty list means that they are gone
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {str(f) for f in store.getAllFiles().mkString("|").split("|") if "shuffle_" in f}
    before = shuffled()
    cut_lineage(spark.range(1000).repartition(3, "id"))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
