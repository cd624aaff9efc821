"""Language identification by words first, then by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.llm.text import chunks, release
from icegrid.session import cut_lineage

UNKNOWN = "und"
# Longest n-gram that an unseen word falls back to, and the length by which evidence is judged.
ORDER = 4
EVIDENCE = 3
# Labelled documents of each language that the model is fitted on, about; chosen by a hash of text
# and label. The most languages: those with the most documents.
FIT_DOCUMENTS = 5_000
LANGUAGES = 1_000
# Words, and n-grams of each length, that the model keeps: the most frequent in any language.
VOCABULARY = 100_000
GRAMS = 40_000
# Least share of a text's words, or of their n-grams, that the model has seen.
LEAST_KNOWN = 0.5
# Words whose rows a task remembers, and counts that it gathers before it hands them over.
REMEMBERED = 100_000
GATHERED = 100_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; none without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return []
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of a word between two blanks; a shorter one is a single gram."""
    padded = f" {word} " if n > 1 else word
    return [padded[k : k + n] for k in range(max(1, len(padded) - n + 1))]


def _rows(words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """kind (0: word, else n-gram length), gram, lang and count, one kind at a time."""
    for lang, found in words.items():
        for n in range(ORDER + 1):
            grams: Counter = Counter() if n else found
            for w, c in found.items() if n else ():
                for g in grams_of(w, n):
                    grams[g] += c
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([n] * len(grams), pa.int32()),
                "gram": pa.array(list(grams), pa.string()),
                "lang": pa.array([lang] * len(grams), pa.string()),
                "count": pa.array(list(grams.values()), pa.int64())})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams, handed over whenever GATHERED words are held."""
    words: dict[str, Counter] = {}
    for batch in batches:
        langs = iter(batch.column("lang").to_pylist())
        for part in chunks(batch.column("text").to_pylist()):
            for text in part:
                words.setdefault(next(langs), Counter()).update(words_of(text))
            if sum(map(len, words.values())) > GATHERED:
                yield from _rows(words)
                words = {}
    yield from _rows(words)
    release()


def _keys(kind: int, grams: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "replace"), kind) for g in grams],
                    np.uint64)


class Model:
    """Log frequencies per language: a row for each word (kind 0) and each n-gram (kind n).

    The words and n-grams are kept as sorted 64-bit hashes, so the model is a few flat arrays.
    """

    def __init__(self, langs: list[str], tables: list[dict[str, int]], logs: np.ndarray):
        keys = np.concatenate([_keys(kind, list(t)) for kind, t in enumerate(tables)])
        rows = np.array([r for t in tables for r in t.values()], np.int32)
        order = np.argsort(keys)
        self.langs, self.logs = langs, np.asarray(logs, np.float64)
        self.keys, self.rows = keys[order], rows[order]
        self.forget()

    def forget(self) -> None:
        """Give back the words that are remembered."""
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(self.langs) + 1))

    def find(self, kind: int, grams: list[str]) -> np.ndarray:
        """Row of each n-gram, -1 if the model lacks it."""
        if not len(self.keys):
            return np.full(len(grams), -1)
        keys = _keys(kind, grams)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rows[at], -1)

    def lines_of(self, words: list[str]) -> np.ndarray:
        """What each word says: log frequencies, its own or the mean of those of its longest known
        n-grams; and the share (1 for a known word) of its n-grams of EVIDENCE that are known."""
        out = np.zeros((len(words), len(self.langs) + 1))
        at = self.find(0, words)
        known = at >= 0
        out[known, :-1], out[known, -1] = self.logs[at[known]], 1
        left = np.flatnonzero(~known)
        for n in range(ORDER, 0, -1):
            # the last n-grams are looked up for evidence even if longer ones are known
            asked = np.flatnonzero(~known) if n == EVIDENCE else left
            if not len(asked):
                continue
            parts = [grams_of(words[k], n) for k in asked]
            sizes = np.array(list(map(len, parts)))
            starts = np.cumsum(sizes) - sizes
            at = self.find(n, [g for p in parts for g in p])
            hits = np.add.reduceat((at >= 0).astype(float), starts)
            if n == EVIDENCE:
                out[asked, -1] = hits / sizes
            logs = np.add.reduceat(np.where((at >= 0)[:, None], self.logs[at], 0), starts)
            new = (hits > 0) & np.isin(asked, left)
            out[asked[new], :-1] = logs[new] / hits[new, None]
            left = np.setdiff1d(left, asked[new])
        return out

    def places_of(self, texts: list[list[str]]) -> np.ndarray:
        """The row of known of every word of the texts, one text after the other."""
        if len(self.place) > REMEMBERED:
            self.forget()
        new = list(set().union(*texts).difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)),
                                  strict=True))
            self.known = np.concatenate([self.known, self.lines_of(new)])
        return np.fromiter((self.place[w] for words in texts for w in words), np.int64,
                           sum(map(len, texts)))

    def predict_many(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, share known) of each text; ties go to the first language by name.

        The score is the language's share of the likelihood, times the share of the words that
        is known. A text without letters, or a model without languages, gives und, 0 and 0.
        """
        words = [words_of(t) for t in texts]
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        some = [k for k, w in enumerate(words) if w]
        if not some or not self.langs:
            return out
        places = self.places_of([words[k] for k in some])
        lines = self.known[places]
        sizes = np.array([len(words[k]) for k in some])
        total = np.add.reduceat(lines, np.cumsum(sizes) - sizes)
        seen, logs = total[:, -1] / sizes, total[:, :-1]
        best = logs.argmax(axis=1)
        odds = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        for k, b, o, s in zip(some, best.tolist(), odds.tolist(), seen.tolist(), strict=True):
            out[k] = (self.langs[b], o * min(1.0, s), s)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_many([text])[0][:2]


def held_out(id_col: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, documents: int = FIT_DOCUMENTS, vocabulary: int = VOCABULARY,
        grams: int = GRAMS) -> Model:
    """Fit on text and lang of labelled; rows without either are left out.

    About documents rows of each language are counted, chosen by a hash, so that a rare language
    is learned from a large table too; the counts are summed by Spark, and the driver gets at
    most vocabulary words and grams n-grams of each length. Each is ranked by its highest
    frequency in a language, so that small languages keep theirs. Runs jobs.
    """
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    total = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    wanted = F.lit(False)
    for r in total:
        share = min(1.0, documents / r["count"])
        part = F.pmod(F.xxhash64("text", "lang", F.lit(11)), F.lit(1 << 32)) < int(share * (1 << 32))
        wanted = wanted | ((F.col("lang") == r["lang"]) & part)
    counts = rows.where(wanted).mapInArrow(_count, "kind int, gram string, lang string, count long")
    counts = counts.groupBy("kind", "gram", "lang").agg(F.sum("count").alias("count"))
    counts = cut_lineage(counts)
    sums = {(r["kind"], r["lang"]): r["n"] for r in
            counts.groupBy("kind", "lang").agg(F.sum("count").alias("n")).collect()}
    langs = sorted({lang for _, lang in sums})
    tables: list[dict[str, int]] = []
    logs: list[np.ndarray] = [np.zeros((0, len(langs)))]
    start = 0
    column = {lang: k for k, lang in enumerate(langs)}
    for kind in range(ORDER + 1):
        size = [sums.get((kind, lang), 0) for lang in langs]
        share_of = F.create_map(*[x for lang, n in zip(langs, size, strict=True)
                                  for x in (F.lit(lang), F.lit(float(n or 1)))]) if langs else None
        table: dict[str, int] = {}
        values: list[np.ndarray] = []
        if langs:
            one = counts.where(F.col("kind") == kind)
            one = one.withColumn("share", F.col("count") / share_of[F.col("lang")])
            top = one.groupBy("gram").agg(
                F.max("share").alias("share"), F.sum("count").alias("total"),
                F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by"),
            )
            if kind == 0:
                top = top.where("total > 1")
            top = top.orderBy(F.desc("share"), "gram").limit(grams if kind else vocabulary)
            for r in top.toLocalIterator():
                table[r["gram"]] = start + len(values)
                line = np.full(len(langs), 0.5)
                for lang, c in r["by"].items():
                    line[column[lang]] += c
                values.append(line)
        seen = np.array(values).reshape(len(values), len(langs))
        tables.append(table)
        start += len(values)
        logs.append(np.log(seen / (np.array(size) + 0.5 * (len(values) + 1))))
    return Model(langs, tables, np.concatenate(logs))


def identify(text: Column, model: Model, spark) -> Column:
    """Struct of lang_pred, score (0 to 1) and known, the share of the text's words that the model
    has seen, for unseen ones of their n-grams; und, 0 and 0 for null and for texts without
    letters.

    The model is bounded (see fit) and sent to each task.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, known double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for series in texts:
            yield pd.DataFrame([x for part in chunks(series) for x in model.predict_many(part)],
                               columns=["lang_pred", "score", "known"])
        model.forget()
        release()

    return run.asNondeterministic()(text)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text",
                    least: float = LEAST_KNOWN) -> DataFrame:
    """docs without texts in no known language: no letters, or less than least of the words known.

    The share of the likelihood cannot tell this: of long texts it is near 1 whatever they are.
    All columns are returned as they are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.select(row.alias("row"),
                        identify(F.col(f"`{text_col}`"), model, docs.sparkSession).alias("l"))
    return found.where((F.col("l.lang_pred") != UNKNOWN) & (F.col("l.known") >= least)) \
        .select("row.*")
