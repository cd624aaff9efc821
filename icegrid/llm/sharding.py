"""Shards of near equal size by longest processing time, with groups that stay together."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icegrid.operators.skew import attach
from icegrid.session import scratch_dir

# Small groups are put in so many bins per shard; a group above a bin's even share of all
# bytes is scheduled by itself. So at most 2 x BINS x shards units go through the heap.
BINS = 1024
# Bytes that every row counts besides its text.
OVERHEAD = 16
# Rows per part when places in a shard are numbered, about.
PART_ROWS = 50_000


def schedule(sizes: list[int], shards: int) -> list[int]:
    """Shard of each unit: by falling size, each to the least loaded shard; ties by number."""
    loads = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        load, shard = heapq.heappop(loads)
        out[k] = shard
        heapq.heappush(loads, (load + sizes[k], shard))
    return out


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  group_col: str | None = None) -> DataFrame:
    """Shard and place in it for every row; rows of a group are never parted.

    A group is an equal text, or an equal value of group_col. Groups are told apart by 64 bits;
    a clash would only keep two of them together. Sizes are UTF-8 bytes of the text plus
    OVERHEAD, a null text has none and is equal to other null texts. Returns id_col, size,
    text_crc32 (of a null text: 0), group, law ('bytes'), shard (0 to shards - 1), slot (from 0
    without gaps in each shard) and grown_shard (null: this law moves rows when shards are
    added). Other columns are not read.

    Shards differ by less than the smallest unit that the last steps place, about 1 / BINS of a
    shard, unless a single group is larger than a shard; it then has one of its own. Repeated
    rows are numbered in any order among each other. Runs jobs; the driver holds the bounded
    list of units. Rows are numbered in parts by hash, so no task sorts a whole shard.
    """
    spark = docs.sparkSession
    key = F.col(group_col) if group_col else F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).alias("text_crc32"),
        F.xxhash64(key, key.isNull()).alias("group"),
    )
    folder = scratch_dir(spark, "shards")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    share = max(1, (total or 0) // (shards * BINS))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    # small groups share bins, whose numbers are below the large groups' keys by kind
    groups = groups.select(
        "group", "bytes", (F.col("bytes") > share).alias("alone"),
        F.when(F.col("bytes") > share, F.col("group")).otherwise(
            F.pmod(F.xxhash64("group", F.lit(1)), F.lit(shards * BINS))).alias("unit"),
    )
    units = groups.groupBy("alone", "unit").agg(F.sum("bytes").alias("bytes"))
    units = [(r["alone"], r["unit"], r["bytes"]) for r in units.toLocalIterator()]
    units.sort(key=lambda u: (-u[2], u[0], u[1]))
    chosen = schedule([u[2] for u in units], shards)
    table = spark.createDataFrame([(u[0], u[1], s) for u, s in zip(units, chosen, strict=True)],
                                  "alone boolean, unit long, shard int")
    placed = attach(groups.select("group", "alone", "unit"), table, ["alone", "unit"], "inner")
    rows = attach(rows, placed.select("group", "shard"), ["group"], "inner")
    parts = max(1, -(-(count or 0) // (shards * PART_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "group"), F.lit(parts)))
    order = Window.partitionBy("shard", "part").orderBy("group", "id", "size")
    numbered = rows.withColumn("n", F.row_number().over(order) - 1)
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("c"))
    below = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part",
                          F.coalesce(F.sum("c").over(below), F.lit(0)).alias("start"))
    out = attach(numbered, starts, ["shard", "part"], "inner")
    return out.select(
        F.col("id").alias(id_col), "size", "text_crc32", "group", F.lit("bytes").alias("law"),
        "shard", (F.col("n") + F.col("start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write docs to folders shard=0, shard=1, ... of path.

    Rows find their shard by id and text, so rows that repeat both are together anyway. A
    column named shard of docs is replaced.
    """
    places = assign_shards(docs, shards, id_col, text_col)
    places = places.select(F.col(id_col).alias("id"), F.col("group").alias("key"), "shard")
    text = F.col(f"`{text_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "shard"])
    named = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"),
                        F.xxhash64(text, text.isNull()).alias("key"))
    out = attach(named, places.distinct(), ["id", "key"], "inner").select("row.*", "shard")
    out.repartition("shard", F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(8))).write.partitionBy(
        "shard").parquet(path)
