"""Near-duplicates by fast similarity sketching, banding and exact verification.

A document's set is its distinct runs of SHINGLE words. The sketch has one coordinate per bin.
Rounds place every element of the set in one hashed bin each; a bin keeps the smallest
(round, hash) it sees, and rounds end when every bin is filled. In the last rounds, round t + j
puts all elements in bin j, so after 2 t rounds every coordinate of a non-empty set is filled.
Two sketches agree in a coordinate with probability equal to the similarity of the sets, and
the share of agreeing coordinates is concentrated like that of independent draws.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.llm.graph import components
from icegrid.llm.sieve import sieve
from icegrid.llm.text import WordHashes, blank_words, chunks, mix
from icegrid.operators.skew import attach, keep, leave
from icegrid.session import cut_lineage, few_parts, scratch_dir

SHINGLE = 5
COORDINATES = 192
# Chance that a pair exactly at the threshold shares no band.
MISS = 1e-6
# A pair is verified if its sketches agree at least as often as the threshold less so many
# standard deviations; beyond five a pair at the threshold is left out once in 3 million.
DEVIATIONS = 5.0
# Sets, and hashes in them, of a block of bucket members that are compared with each other.
BLOCK = 1024
BLOCK_HASHES = 1 << 21

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def bands_for(threshold: float, t: int = COORDINATES) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold at most with MISS."""
    for rows in range(t // 2, 1, -1):
        if (1 - threshold**rows) ** (t // rows) <= MISS:
            return t // rows, rows
    return t, 1


def least_agreement(threshold: float, t: int = COORDINATES) -> int:
    """Fewest agreeing coordinates of a pair that is verified."""
    return max(1, int(np.floor(t * threshold - DEVIATIONS * np.sqrt(t * threshold * (1 - threshold)))))


def shingle_sets(texts: list[str | None], size: int = SHINGLE,
                 hashes: WordHashes | None = None) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of size words of each text.

    A text with fewer words is one run; one without words has the empty set.
    """
    words = [blank_words(t) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    flat = (WordHashes() if hashes is None else hashes).of([w for part in words for w in part])
    del words
    starts = np.concatenate([[0], np.cumsum(counts)])
    factor = np.uint64(0x9E3779B97F4A7C15)
    runs = flat[: max(0, len(flat) - size + 1)].copy()
    for k in range(1, size):
        runs = runs * factor + flat[k : k + len(runs)]
    runs = mix(runs)
    out = []
    for start, n in zip(starts[:-1], counts, strict=True):
        if n >= size:
            out.append(np.unique(runs[start : start + n - size + 1]))
        elif n:
            value = np.array([n], np.uint64)
            for k in range(start, start + n):
                value = value * factor + flat[k]
            out.append(mix(value + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of t coordinates per set; of the empty set all are _EMPTY."""
    sizes = np.array([len(s) for s in sets], np.int64)
    doc = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = np.full(len(sets) * t, _EMPTY)
    bins = np.uint64(t)
    for i in range(2 * t):
        if not len(flat):
            break
        x = mix(flat + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        value = np.uint64(i << 32) | (x & np.uint64(0xFFFFFFFF))
        if i < t:
            place = ((x >> np.uint64(32)) * bins >> np.uint64(32)).astype(np.int64)
        else:
            place = np.int64(i - t)
        np.minimum.at(out, doc * t + place, value)
        open_ = (out.reshape(-1, t) == _EMPTY).any(axis=1)
        left = open_[doc]
        if not left.all():
            flat, doc = flat[left], doc[left]
    return out.reshape(-1, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch; the band's number is part of it."""
    cut = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
    return key.view(np.int64)


def _sign(texts: Iterator[pd.Series], bands: int, rows: int, size: int) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for series in texts:
        parts = []
        for part in chunks(series):
            sets = shingle_sets(part, size, hashes)
            sketch = sketches(sets)
            keys = band_keys(sketch, bands, rows)
            bytes_ = (mix(sketch) >> np.uint64(56)).astype(np.uint8)
            full = [len(s) > 0 for s in sets]
            parts.append(pd.DataFrame({
                "n": [len(s) for s in sets],
                "node": np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets],
                                 np.uint64).view(np.int64),
                "bands": [k if f else None for k, f in zip(keys, full, strict=True)],
                "sketch": [b.tobytes() if f else None
                           for b, f in zip(bytes_, full, strict=True)],
            }))
        yield pd.concat(parts) if parts else pd.DataFrame(
            {"n": [], "node": [], "bands": [], "sketch": []}
        )


def signatures(text: Column, threshold: float, size: int = SHINGLE) -> Column:
    """Struct of n (set size), node (64-bit name of the set), bands and sketch."""
    bands, rows = bands_for(threshold)

    @F.pandas_udf("n long, node long, bands array<long>, sketch binary")
    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _sign(texts, bands, rows, size)

    return sign.asNondeterministic()(text)


def full_sets(text: Column, size: int = SHINGLE) -> Column:
    """All hashes of a document's set."""

    @F.pandas_udf("array<long>")
    def make(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for series in texts:
            out = []
            for part in chunks(series):
                out += [s.view(np.int64) for s in shingle_sets(part, size, hashes)]
            yield pd.Series(out, dtype=object)

    return make.asNondeterministic()(text)


def _agreement(a: Column, b: Column) -> Column:
    """Coordinates in which two sketches agree."""

    @F.pandas_udf("int")
    def count(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="int32")
        x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), np.uint8).reshape(len(a), -1)
        return pd.Series((x == y).sum(axis=1).astype(np.int32))

    return count.asNondeterministic()(a, b)


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    size: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Class of each document; two are linked if their sets' similarity is threshold or more.

    Returns one row per row of docs: id_col, text_hash (xxhash64 of the text), n_shingles,
    node (name of the set, by 64 bits), component_id (smallest id reachable by links, itself
    included), component (smallest node reachable) and kept (id = component_id). Other columns of docs are not read, whatever their
    names. Null or wordless texts have no shingles and link with nothing. Equal sets are one
    node, so copies are never paired. Rows that repeat an id share its component. A null id
    counts for nothing while its component has another; if all are null, component_id is null
    and all are kept. Runs jobs and writes sketches to the shared folder.

    1. Buckets are bands with two sets or more; each member is checked with the smallest.
    2. Where members other than the smallest are still in different components, all of them are
       compared, block by block; only links that join two components are written.
    A check compares the full sets. Similar pairs are missed with a chance of about MISS.
    """
    spark = docs.sparkSession
    ident = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ident = ident.withColumn("text_hash", F.xxhash64("text"))
    folder = scratch_dir(spark, "sketches")
    signed = ident.select("id", "text_hash", signatures(F.col("text"), threshold, size).alias("s"))
    signed.select("id", "text_hash", "s.*").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    # every table below has at most a row for each band of a set, or the sets themselves
    count, hashes = rows.agg(F.count("*"), F.sum("n")).first()
    parts = few_parts(spark, 32 * bands_for(threshold)[0] * count + 8 * (hashes or 0))
    one = F.min(F.struct("id", "text_hash"))
    sets = rows.where("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"), one.alias("seen"),
    )
    sets.coalesce(parts).write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")

    placed = sets.select("node", F.explode("bands").alias("band"))
    buckets = placed.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    buckets = buckets.where("low <> high").drop("high")
    members = cut_lineage(attach(placed, buckets, ["band"], "inner"), parts)

    links = _star_links(members, ident, sets, threshold, size, parts)
    roots = components(links)
    open_ = _open_blocks(members, roots, sets, threshold, block, parts)
    if not open_.isEmpty():
        known = roots.where("node <> root").select(
            F.col("node").alias("u"), F.col("root").alias("v"))
        roots = components(known.unionAll(_block_links(open_, ident, sets, threshold, size, parts)))
    return _classes(rows, roots, id_col)


def _classes(rows: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    """Rows with their component; a set without links, and each row without a set, is its own."""
    label = attach(rows.select("id", "text_hash", F.col("n").alias("n_shingles"), "node"),
                   roots, ["node"])
    label = label.withColumn("root", F.coalesce("root", "node"))
    least = label.where("n_shingles > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    out = attach(label, least, ["root"])
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = out.withColumn("component_id", own)
    return out.select(
        F.col("id").alias(id_col), "text_hash", "n_shingles", "node", "component_id",
        F.col("root").alias("component"), F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _hashes(nodes: DataFrame, ident: DataFrame, sets: DataFrame, size: int,
            parts: int | None) -> DataFrame:
    """node and its full set, made anew from one text for each of the nodes."""
    wanted = attach(sets.select("node", "seen"), nodes.distinct().withColumn("yes", F.lit(True)),
                    ["node"], "inner").select("node", "seen.*")
    wanted = cut_lineage(wanted.withColumn("key", F.xxhash64("id", "text_hash")), parts)
    test = sieve(wanted, "key")
    texts = ident.withColumn("key", F.xxhash64("id", "text_hash")).where(test(F.col("key")))
    texts = attach(texts.drop("key"), wanted.drop("key"), ["id", "text_hash"], "inner")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    return cut_lineage(texts.select("node", full_sets(F.col("text"), size).alias("set")), parts)


def _star_links(members: DataFrame, ident: DataFrame, sets: DataFrame, threshold: float,
                size: int, parts: int | None = None) -> DataFrame:
    """Links u, v of members with the smallest of their bucket: by size, sketch and full sets."""
    pairs = members.where("node <> low").select(
        F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    side = sets.select("node", "n", "sketch")
    for end in ("a", "b"):
        pairs = attach(pairs, side.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"),
                                          F.col("sketch").alias(f"s_{end}")), [end], "inner")
    near = F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-6
    pairs = pairs.where(near).withColumn("same", _agreement(F.col("s_a"), F.col("s_b")))
    pairs = pairs.where(F.col("same") >= least_agreement(threshold))
    pairs = cut_lineage(pairs.drop("same", "s_a", "s_b"), parts)
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b"))
    hashes = _hashes(nodes, ident, sets, size, parts)
    for end in ("a", "b"):
        pairs = attach(pairs, hashes.select(F.col("node").alias(end),
                                            F.col("set").alias(f"set_{end}")), [end], "inner")
    both = F.size(F.array_intersect("set_a", "set_b"))
    # in whole thousandths, so that a pair at the threshold is on the right side
    union = F.col("n_a") + F.col("n_b") - both
    similar = both * 1000 >= F.lit(round(threshold * 1000)) * union
    return cut_lineage(pairs.where(similar).select(F.col("a").alias("u"), F.col("b").alias("v")),
                       parts)


def _open_blocks(members: DataFrame, roots: DataFrame, sets: DataFrame, threshold: float,
                 block: int, parts: int | None = None) -> DataFrame:
    """Members of several components in a bucket, without its smallest, that may be similar.

    A bucket's largest component and its other sets are cut into blocks by hash, of about block
    sets and BLOCK_HASHES hashes at most; a bucket that fits is one block. Each pair of blocks
    i, j is a group, but for two of the largest component: there is nothing to compare. So
    its sets are copied once for each block of the others. Only those members of a group remain
    whose sketch agrees often enough with that of another component's member.
    """
    named = attach(members.where("node <> low").select("band", "node"), roots, ["node"])
    named = named.withColumn("root", F.coalesce("root", "node"))
    rows = cut_lineage(attach(named, sets.select("node", "n"), ["node"], "inner"), parts)
    shares = rows.groupBy("band", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    mixed = shares.groupBy("band").agg(
        F.count("*").alias("roots"), F.max(F.struct("c", "s", "root")).alias("most"),
        F.sum("c").alias("c"), F.sum("s").alias("s")).where("roots > 1")

    def blocks(c: Column, s: Column) -> Column:
        return F.greatest(F.ceil(c / block), F.ceil(s / BLOCK_HASHES)).cast("int")

    rest = F.col("c") - F.col("most.c"), F.col("s") - F.col("most.s")
    whole = blocks(F.col("c"), F.col("s")) == 1
    mixed = mixed.select(
        "band", F.col("most.root").alias("most"),
        F.when(whole, 1).otherwise(blocks(*rest)).alias("few"),
        F.when(whole, 0).otherwise(blocks(F.col("most.c"), F.col("most.s"))).alias("many"))
    rows = attach(rows, mixed, ["band"], "inner")
    rows = attach(rows, sets.select("node", "sketch", "bands"), ["node"], "inner")
    # blocks of the others come first, then those of the largest component
    inside = (F.col("root") == F.col("most")) & (F.col("many") > 0)
    place = F.xxhash64("node", F.lit(7))
    rows = rows.withColumn("own", F.when(inside, F.col("few") + F.pmod(place, F.col("many")))
                           .otherwise(F.pmod(place, F.col("few"))).cast("int"))
    last = F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select("band", F.least("own", "other").alias("i"),
                       F.greatest("own", "other").alias("j"), "own", "node", "root", "n", "sketch",
                       "bands")
    pick = partial(_by_group, partial(_likely, least_agreement(threshold), threshold))
    return cut_lineage(_grouped(rows).mapInPandas(pick, rows.schema), parts)


def _block_links(open_: DataFrame, ident: DataFrame, sets: DataFrame, threshold: float,
                 size: int, parts: int | None = None) -> DataFrame:
    """Links u, v that join all similar members of each group, by their full sets."""
    hashes = _hashes(open_.select("node"), ident, sets, size, parts)
    rows = attach(open_, hashes, ["node"], "inner")
    link = partial(_by_group, partial(_confirmed, least_agreement(threshold), threshold))
    return cut_lineage(_grouped(rows).mapInPandas(link, "u long, v long"), parts)


def _grouped(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "band", "i", "j")
    return rows.sortWithinPartitions("band", "i", "j", "node")


def _by_group(run, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """run on each stretch of rows with equal band, i, j; stretches may cross batches."""
    keys = ["band", "i", "j"]
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch[keys].to_numpy()
        cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
        if rest and (rest[-1][keys].to_numpy()[-1] != key[0]).any():
            cuts.insert(0, 0)
        for lo, hi in zip([0, *cuts], [*cuts, None], strict=True):
            if hi is None:
                rest.append(batch.iloc[lo:])
            else:
                yield from run(pd.concat([*rest, batch.iloc[lo:hi]], ignore_index=True))
                rest = []
    if rest:
        yield from run(pd.concat(rest, ignore_index=True))


def _likely_pairs(rows: pd.DataFrame, least: int, threshold: float):
    """(x, places y after x) of a group: pairs of different components, of near sizes and with
    sketches that agree, in the first band that they share."""
    own, node, root, n = (rows[c].to_numpy() for c in ("own", "node", "root", "n"))
    inner = rows["i"].iat[0] == rows["j"].iat[0]
    band = rows["band"].iat[0]
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
    bands = np.array(rows["bands"].tolist(), np.int64)
    at = int(np.flatnonzero(bands[0] == band)[0])
    for x in range(len(rows) - 1):
        y = np.arange(x + 1, len(rows))
        y = y[(root[y] != root[x]) & (node[y] != node[x]) & (inner | (own[y] != own[x]))]
        y = y[np.minimum(n[y], n[x]) >= threshold * np.maximum(n[y], n[x]) - 1e-6]
        if len(y):
            y = y[(bands[y, :at] != bands[x, :at]).all(axis=1)]
        if len(y):
            y = y[(sketch[y] == sketch[x]).sum(axis=1) >= least]
        if len(y):
            yield x, y


def _likely(least: int, threshold: float, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    used = np.zeros(len(rows), bool)
    for x, y in _likely_pairs(rows, least, threshold):
        used[x] = True
        used[y] = True
    if used.any():
        yield rows[used]


def _confirmed(least: int, threshold: float, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    thousandths = round(threshold * 1000)
    node, sets = rows["node"].to_numpy(), rows["set"]
    label = np.unique(rows["root"], return_inverse=True)[1]
    u, v = [], []
    for x, others in _likely_pairs(rows, least, threshold):
        for y in others:
            if label[x] == label[y]:
                continue
            a, b = sets.iat[x], sets.iat[y]
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both * 1000 >= thousandths * (len(a) + len(b) - both):
                label[label == label[y]] = label[x]
                u.append(node[x])
                v.append(node[y])
    if u:
        yield pd.DataFrame({"u": u, "v": v})


def without_near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = SHINGLE,
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: the one of smallest id, then text hash.

    All columns are returned as they are, whatever their names. Rows of null or wordless text
    are all kept, but for exact repeats of id and text. Of rows that repeat an id and a text
    one is kept. A null id is kept only if its component has no other.
    """
    classes = near_duplicates(docs, threshold, size, id_col, text_col)
    classes = classes.withColumnRenamed(id_col, "id")
    # rows without a set are groups of their own
    group = F.when(F.col("n_shingles") > 0, F.struct(
        F.col("component").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).alias("kind")
    )).otherwise(F.struct(F.xxhash64("id").alias("a"), F.col("text_hash").alias("b"),
                          F.lit(1).alias("kind")))
    first = F.struct(F.col("id").isNull(), F.col("id"), F.col("text_hash"))
    marked = classes.select("id", "text_hash", group.alias("g"), first.alias("me"))
    best = marked.groupBy("g").agg(F.min("me").alias("best"))
    chosen = attach(marked, best, ["g"], "inner")
    state = chosen.groupBy("id", "text_hash").agg(
        F.min(F.col("me").eqNullSafe(F.col("best"))).alias("keep"), F.count("*").alias("copies")
    )
    # rows to be dropped, and rows of which one copy stays
    touched = cut_lineage(state.where("not keep or copies > 1"))
    touched = touched.withColumn("key", F.xxhash64("id", "text_hash"))
    test = sieve(touched, "key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"),
                         F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"))
    packed = packed.withColumn("maybe", test(F.xxhash64("id", "text_hash")))
    clear = packed.where("not maybe").select("row.*")
    rest = packed.where("maybe").drop("maybe")
    left = leave(rest, touched, ["id", "text_hash"]).select("row.*")
    twice = keep(rest, touched.where("keep"), ["id", "text_hash"])
    once = twice.groupBy("id", "text_hash").agg(F.first("row").alias("row")).select("row.*")
    return clear.unionAll(left).unionAll(once)
