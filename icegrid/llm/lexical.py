"""Ranked lexical search with hashed max-sketches.

A term counts for a document by its impact, which grows with its occurrences and falls with the
length of the document. A document's sketch holds, for each of a number of hashed coordinates,
the largest impact of its terms there. The weighted sum of an item's coordinates is then never
below the item's score, so documents are scored exactly in the order of these bounds until the
next bound is below the score that is wanted.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icegrid.llm.text import WordHashes, alnum_words, chunks
from icegrid.session import scratch_dir

TOP = 10
# Coordinates of a sketch, and documents whose sketches a task holds at once.
COORDINATES = 8192
SKETCHES = 500
# Bytes of item texts that the driver and each task hold at once.
BLOCK_BYTES = 4 << 20


class Corpus:
    """Documents with a term, terms in all with repeats, and the weight of each term asked for."""

    def __init__(self, documents: int, terms: int, holders: dict[bytes, int]):
        self.documents, self.terms = documents, terms
        self.weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * holders.get(t, 0) + 1)))
                       for t in holders}

    def share(self, n):
        """How long a document of n terms is, in hundredths of the mean with a base of 25."""
        return 100 - 75 + (75 * n * self.documents) // self.terms


def impact(tf, m):
    """What tf occurrences count in a document of share m; whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Item:
    """Terms of an item with weight times repeats, and the same summed by coordinate."""

    def __init__(self, words: list[bytes], corpus: Corpus, hashes: WordHashes, coordinates: int):
        count = Counter(words)
        self.terms = {t: c * corpus.weight[t] for t, c in count.items()}
        at = hashes.of(list(self.terms)) % np.uint64(coordinates)
        self.places, which = np.unique(at.astype(np.int64), return_inverse=True)
        self.weights = np.zeros(len(self.places))
        np.add.at(self.weights, which, list(self.terms.values()))


class Reversed:
    """An id whose order is turned round; null ids come after all others."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other: Reversed) -> bool:
        a, b = self.value, other.value
        return a is None and b is not None if a is None or b is None else b < a


def walk(bounds: np.ndarray, best: list, k: int, score, ids: list) -> int:
    """Put the k best documents into the heap best: (score, reversed id, id); count the scored.

    Documents are scored by descending bound until one is below the k-th score. A bound equal to
    it may still win by its id.
    """
    least = max(1, best[0][0] if len(best) == k else 1)
    chosen = np.flatnonzero(bounds >= least)
    scored = 0
    for d in chosen[np.argsort(-bounds[chosen], kind="stable")].tolist():
        if len(best) == k and bounds[d] < best[0][0]:
            break
        scored += 1
        if (value := score(d)) > 0:
            entry = (value, Reversed(ids[d]), scored)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif best[0] < entry:
                heapq.heapreplace(best, entry)
    return scored


def sketches(words: list[list[bytes]], shares: list[int], hashes: WordHashes,
             coordinates: int) -> np.ndarray:
    """Largest impact at each coordinate (row) of each document (column); exact in 32 bits."""
    out = np.zeros((len(words), coordinates), np.float32)
    for row, w, m in zip(out, words, shares, strict=True):
        term, tf = np.unique(hashes.of(w), return_counts=True)
        np.maximum.at(row, (term % np.uint64(coordinates)).astype(np.int64), impact(tf, m))
    return np.ascontiguousarray(out.T)


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]
            ) -> Iterator[pa.RecordBatch]:
    """Documents holding each term; term -1: documents with terms; -2: terms with repeats."""
    asked = frozenset(vocabulary)
    found: Counter = Counter()
    documents = terms = 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            words = alnum_words(text)
            documents += bool(words)
            terms += len(words)
            found.update(asked.intersection(words))
    rows = [(vocabulary[t], n) for t, n in found.items()] + [(-1, documents), (-2, terms)]
    yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in rows], pa.int64()),
                                      "n": pa.array([n for _, n in rows], pa.int64())})


def _search(batches: Iterator[pa.RecordBatch], items: list[list[bytes]], corpus: Corpus, k: int,
            coordinates: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of one task for each item."""
    hashes = WordHashes()
    queries = [Item(w, corpus, hashes, coordinates) for w in items]
    best: list[list] = [[] for _ in queries]
    kind = None
    for batch in batches:
        kind = batch.schema.field("id").type
        rows = iter(batch.column("id").to_pylist())
        for part in chunks(batch.column("text").to_pylist()):
            for lo in range(0, len(part), SKETCHES):
                pairs = [(next(rows), alnum_words(t)) for t in part[lo : lo + SKETCHES]]
                pairs = [(i, w) for i, w in pairs if w]
                if pairs:
                    _score(pairs, queries, best, corpus, k, hashes, coordinates)
    if kind is not None:
        flat = [(q, e[1].value, e[0]) for q, found in enumerate(best) for e in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], kind),
             pa.array([x[2] for x in flat], pa.int64())], names=["item", "id", "score"])


def _score(pairs: list, queries: list[Item], best: list[list], corpus: Corpus, k: int,
           hashes: WordHashes, coordinates: int) -> None:
    ids, words = [i for i, _ in pairs], [w for _, w in pairs]
    shares = [corpus.share(len(w)) for w in words]
    table = sketches(words, shares, hashes, coordinates)
    seen: dict[int, Counter] = {}
    for item, found in zip(queries, best, strict=True):
        def score(d: int, item=item) -> int:
            if d not in seen:
                seen[d] = Counter(words[d])
            count, m = seen[d], shares[d]
            return sum(w * impact(tf, m) for t, w in item.terms.items() if (tf := count.get(t)))

        # whole numbers below 2^53, so the bound is exact
        walk(item.weights @ table[item.places].astype(np.float64), found, k, score, ids)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Distinct rows of items in lists of about block_bytes of text, read one after the other."""
    spark = items.sparkSession
    items = items.where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    if n > 1:
        folder = scratch_dir(spark, "items")
        part = F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int").alias("part")
        items.select("item", "text", part).write.partitionBy("part").parquet(folder)
        items = spark.read.parquet(folder)
    for k in range(n):
        yield (items.where(F.col("part") == k) if n > 1 else items).select("item", "text").collect()


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           coordinates: int = COORDINATES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k documents of highest score for each item: item_col, rank, id_col, score.

    Terms are runs of letters, digits and non-ASCII characters with A-Z lower-cased. N is the
    number of documents with a term, L all their terms, n one document's, df the documents that
    hold a term, tf its occurrences in one. A term weighs floor(1000 ln((2N+2)/(2df+1))); with
    m = 25 + 75nN div L a document scores the sum over the item's terms, repeats included, of
    weight * (10^9 tf div (1000 tf + 8m)). Only scores above 0 are returned, equal ones by
    ascending id with null ids last; rank counts from 1.

    Null and wordless texts match nothing. Repeated rows of docs are documents of their own;
    repeated rows of items are one item, one id with several texts is several. Other columns
    are not read. Two scans of docs for each block of items (about block_bytes of text, which the
    driver and each task hold), whatever their number; a task keeps k documents for an item, and
    these are ranked after one shuffle. The statistics are over all documents. Runs jobs.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where("text is not null")
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = None
    for block in _blocks(asked, block_bytes):
        words = [w for r in block if (w := alnum_words(r["text"]))]
        names = [r["item"] for r in block if alnum_words(r["text"])]
        vocabulary = {t: j for j, t in enumerate(dict.fromkeys(t for w in words for t in w))}
        shared = spark.sparkContext.broadcast(vocabulary)
        counts = rows.select("text").mapInArrow(
            lambda b, v=shared: _counts(b, v.value), "term long, n long")
        sums = {r[0]: r[1] for r in counts.groupBy("term").agg(F.sum("n")).collect()}
        shared.unpersist()
        corpus = Corpus(sums.get(-1, 0), sums.get(-2, 0),
                        {t: sums.get(j, 0) for t, j in vocabulary.items()})
        query = spark.sparkContext.broadcast((words, corpus))
        found = rows.mapInArrow(
            lambda b, q=query: _search(b, *q.value, k, coordinates),
            f"item long, id {id_type}, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        name = spark.createDataFrame(list(enumerate(names)),
                                     f"item long, name {asked.schema['item'].dataType.simpleString()}")
        found = found.join(name, "item").select(F.col("name").alias(item_col), "rank",
                                                F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionAll(found)
    if out is None:
        kind = asked.schema["item"].dataType.simpleString()
        out = spark.createDataFrame([], f"item {kind}, rank int, id {id_type}, score long")
        out = out.toDF(item_col, "rank", id_col, "score")
    return out
