"""Verbatim benchmark passages in documents, by suffix arrays over the training text.

Each batch of documents is a shard. Its suffix array orders the suffixes of the training words;
the suffixes of benchmark items whose first word it has are binary-searched in it, word by
word, until a suffix has no further match. Only runs of words that occur in the benchmark are put in the array:
no match can hold another word, and a run shorter than every window holds none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.llm.text import alnum_words, chunks
from icegrid.operators.skew import attach
from icegrid.session import scratch_dir

WINDOW = 10
# Bytes of benchmark text that one pass holds in memory; a larger benchmark takes more jobs.
BLOCK_BYTES = 1 << 24

FIELDS = ("n_words long, n_hit long, items array<string>, "
          "longest long, spans array<struct<start:long,end:long>>")


class Items:
    """A block of benchmark items as numbered words, and the suffixes that start a window."""

    def __init__(self, rows: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        flat: list[int] = []
        start: list[int] = []
        end: list[int] = []
        need: list[int] = []
        owner: list[int] = []
        for name, text in rows:
            words = alnum_words(text)
            if not words:
                continue
            size = min(window, len(words))
            at = len(flat)
            flat += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for k in range(len(words) - size + 1):
                start.append(at + k)
                end.append(len(flat))
                need.append(size)
                owner.append(len(self.names))
            self.names.append(name)
        self.flat = np.array(flat, np.int64)
        self.start, self.end = np.array(start, np.int64), np.array(end, np.int64)
        self.need, self.owner = np.array(need, np.int64), np.array(owner, np.int64)
        self.shortest = min(need, default=0)
        self.longest = int((self.end - self.start).max()) if start else 0


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """starts in the order of their suffixes, compared by at least depth words.

    Prefixes are doubled: in each round a suffix is ranked by its own rank and that of the
    suffix one prefix further. Past the end is smaller than any word.
    """
    rank = np.concatenate([np.unique(words, return_inverse=True)[1] + 1, [0]]).astype(np.int64)
    n, h = len(words), 1
    while h < depth:
        ahead = np.minimum(np.arange(n) + h, n)
        key = rank[:n] * (n + 2) + rank[ahead]
        rank[:n] = np.unique(key, return_inverse=True)[1] + 1
        h *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def search(words: np.ndarray, order: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """For each item suffix, the range of the array whose suffixes begin with its window."""
    low, high = np.zeros((2, len(items.start)), np.int64)
    seen = np.zeros(len(items.vocabulary) + 1, bool)
    seen[words] = True
    live = np.flatnonzero(seen[items.flat[items.start]])
    high[live] = len(order)
    padded = np.concatenate([words, [0]])
    for depth in range(int(items.need.max(initial=0))):
        live = live[(high[live] > low[live]) & (items.need[live] > depth)]
        if not len(live):
            break
        wanted = items.flat[items.start[live] + depth]
        first, last = low[live], high[live]
        low[live] = _bound(padded, order, first, last, depth, wanted, False)
        high[live] = _bound(padded, order, first, last, depth, wanted, True)
    return low, np.maximum(low, high)


def _bound(padded, order, low, high, depth, wanted, after):
    """First place in low..high whose word at depth is not below (after: is above) wanted."""
    low, high = low.copy(), high.copy()
    end = len(padded) - 1
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        at = order[np.minimum(middle, len(order) - 1)] + depth
        word = padded[np.minimum(at, end)]
        right = open_ & ((word <= wanted) if after else (word < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def _extend(words: np.ndarray, at: np.ndarray, items: Items, suffix: np.ndarray) -> np.ndarray:
    """Words that the training text at each place shares with an item suffix."""
    padded = np.concatenate([words, [0]])
    size = items.need[suffix].copy()
    live = np.arange(len(at))
    while len(live):
        more = items.start[suffix[live]] + size[live]
        inside = (more < items.end[suffix[live]])
        live, more = live[inside], more[inside]
        same = padded[np.minimum(at[live] + size[live], len(words))] == items.flat[more]
        live = live[same]
        size[live] += 1
    return size


def scan(texts: list[str | None], items: Items) -> pd.DataFrame:
    """One row of FIELDS per text; the texts are one shard."""
    numbers, counts = [], []
    get = items.vocabulary.get
    for text in texts:
        words = alnum_words(text)
        counts.append(len(words))
        numbers.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
    n = len(texts)
    out = pd.DataFrame({
        "n_words": counts, "n_hit": 0, "items": [[] for _ in range(n)], "longest": 0,
        "spans": [[] for _ in range(n)],
    })
    if not items.names:
        return out
    # a 0 after each text, so that no run crosses into the next
    flat = np.concatenate([x for part in numbers for x in (part, np.zeros(1, np.int64))])
    first = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
    known = flat > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    long_ = stop - begin >= items.shortest
    begin, stop = begin[long_], stop[long_]
    if not len(begin):
        return out
    sizes = stop - begin + 1
    shift = np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    place = np.arange(sizes.sum()) + shift
    words = np.where(place < np.repeat(stop, sizes), flat[np.minimum(place, len(flat) - 1)], 0)
    room = np.repeat(stop, sizes) - place >= items.shortest
    order = suffix_array(words, np.flatnonzero(room), items.longest)
    low, high = search(words, order, items)
    suffix = np.repeat(np.arange(len(low)), high - low)
    if not len(suffix):
        return out
    inner = np.arange(len(suffix)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = order[low[suffix] + inner]
    length = _extend(words, at, items, suffix)
    where = place[at]
    doc = np.searchsorted(first, where, side="right") - 1
    # words in any window
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, where, 1)
    np.add.at(cover, where + items.need[suffix], -1)
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    owner = np.searchsorted(first, begin, side="right") - 1
    hits, spans, names = out["n_hit"].to_numpy().copy(), out["spans"], out["items"]
    for d, b, e in zip(owner, begin, stop, strict=True):
        hits[d] += e - b
        spans[d].append({"start": int(b - first[d]), "end": int(e - first[d])})
    for d, i in np.unique(np.stack([doc, items.owner[suffix]], axis=1), axis=0):
        names[d].append(items.names[i])
    best = out["longest"].to_numpy().copy()
    np.maximum.at(best, doc, length)
    out["n_hit"], out["longest"] = hits, best
    out["items"] = [sorted(set(x)) for x in names]
    return out


def _union(spans) -> list[dict]:
    merged: list[dict] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1]["end"]:
            merged[-1]["end"] = max(merged[-1]["end"], int(end))
        else:
            merged.append({"start": int(start), "end": int(end)})
    return merged


def _merge(blocks: list[pd.DataFrame]) -> pd.DataFrame:
    """Results of several blocks of the benchmark for the same texts."""
    out = blocks[0].copy()
    items, spans, hits, longest = [], [], [], []
    for parts in zip(*(b.itertuples(index=False) for b in blocks), strict=True):
        items.append(sorted({x for p in parts for x in p.items}))
        longest.append(max(p.longest for p in parts))
        merged = _union((s["start"], s["end"]) for p in parts for s in p.spans)
        spans.append(merged)
        hits.append(sum(s["end"] - s["start"] for s in merged))
    out["items"], out["spans"], out["n_hit"], out["longest"] = items, spans, hits, longest
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """(number of blocks, the items of each in turn): lists of about block_bytes of text.

    Several blocks are first written to the shared folder, cut by a hash of the item.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
                            F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-int(total) // block_bytes) or 1
    if n > 1:
        folder = scratch_dir(spark, "benchmark")
        part = F.pmod(F.xxhash64("name", "text"), F.lit(n)).cast("int")
        rows.withColumn("part", part).write.partitionBy("part").parquet(folder)
        rows = spark.read.schema("name string, text string, part int").parquet(folder)

    def read():
        for k in range(n):
            chosen = rows if n == 1 else rows.where(F.col("part") == k)
            yield [(r["name"], r["text"]) for r in chosen.select("name", "text").collect()]

    return n, read()


def leaks(text: Column, benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id",
          text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Column:
    """Struct of FIELDS for a text column: what the benchmark's windows hit in each text.

    A window is window consecutive words of an item; an item with fewer is one window, one
    without words has none. items are the ids, as sorted strings, of the items with a window in
    the text; longest is the longest verbatim match; spans are the word ranges hit. A null or
    wordless text is hit by nothing. A null item id counts as the empty string, repeated ids
    once. A column is made by one job, so each task holds the whole benchmark, in blocks; use
    find_leaks for one of more than a block. Runs small jobs on the benchmark.
    """
    spark = benchmark.sparkSession
    columns = []
    for rows in _blocks(benchmark, id_col, text_col, block_bytes)[1]:
        shared = spark.sparkContext.broadcast(rows)
        columns.append(_scanner(shared, window)(text))
    if len(columns) == 1:
        return columns[0]

    @F.pandas_udf(FIELDS)
    def merge(parts: Iterator[tuple[pd.DataFrame, ...]]) -> Iterator[pd.DataFrame]:
        for blocks in parts:
            yield _merge(list(blocks))

    return merge.asNondeterministic()(*columns)


def _scanner(shared, window: int):
    @F.pandas_udf(FIELDS)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        items = Items(shared.value, window)
        for series in texts:
            parts = [scan(part, items) for part in chunks(series)]
            yield pd.concat(parts, ignore_index=True) if parts else scan([], items)

    return run.asNondeterministic()


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               text_col: str = "text", id_col: str = "item_id", item_text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row (struct of the columns of docs) and leak (see leaks) of each row of docs.

    The driver and each task hold one block of the benchmark. If there are several, each is a
    job over the documents that writes its hits; its block is released before the next is read.
    Hits are merged by a digest of the text, and joined to the rows. Runs jobs.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    n, blocks = _blocks(benchmark, id_col, item_text_col, block_bytes)
    if n == 1:
        shared = spark.sparkContext.broadcast(next(blocks))
        return rows.select("row", _scanner(shared, window)(F.col("text")).alias("leak"))
    folder = scratch_dir(spark, "leaks")
    rows = rows.withColumn("key", F.sha2("text", 256))
    for k, items in enumerate(blocks):
        shared = spark.sparkContext.broadcast(items)
        leak = _scanner(shared, window)(F.col("text")).alias("leak")
        found = rows.where("text is not null").select("key", leak).where("leak.n_hit > 0")
        found = found.select("key", F.lit(k).alias("block"), "leak.items", "leak.longest",
                             "leak.spans")
        found.write.mode("append").parquet(folder)
        shared.destroy()
    hits = spark.read.schema("key string, block int, items array<string>, longest long, "
                             "spans array<struct<start:long,end:long>>").parquet(folder)
    # copies of a text have the same hits
    hits = hits.groupBy("key", "block").agg(*[F.first(c).alias(c)
                                              for c in ("items", "longest", "spans")])
    hits = hits.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"), F.flatten(F.collect_list("spans")).alias("spans"))
    hits = hits.withColumn("spans", _joined(F.col("spans.start"), F.col("spans.end")))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    hits = hits.withColumn("n_hit", length)
    out = attach(rows.select("row", "key", _word_count(F.col("text")).alias("n_words")), hits,
                 ["key"])
    empty = {"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
             "longest": F.lit(0).cast("long"),
             "spans": F.array().cast("array<struct<start:long,end:long>>")}
    return out.select("row", F.struct("n_words", *[F.coalesce(c, v).alias(c)
                                                   for c, v in empty.items()]).alias("leak"))


def _word_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([len(alnum_words(t)) for t in series], dtype="int64")

    return run.asNondeterministic()(text)


def _joined(starts: Column, ends: Column) -> Column:
    """Spans in order, those that overlap or touch as one."""

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def run(starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([_union(zip(*x)) for x in zip(starts, ends, strict=True)], dtype=object)

    return run.asNondeterministic()(starts, ends)


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


def digest_of(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  text_col: str = "text", **kw) -> DataFrame:
    """docs without the rows that hold a window of the benchmark; all columns as they are."""
    marked = find_leaks(docs, benchmark, window, text_col, **kw)
    return marked.where("leak.n_hit = 0").select("row.*")
