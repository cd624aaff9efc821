"""Toxicity by a support vector machine on gapped character subsequences of words.

Two words are alike by the subsequences of three characters they share, with or without other
characters between them: one that spans n characters counts DECAY^n, and a word's counts are
scaled to length 1. So inflected, gapped and padded forms stay close to the word. Nyström
landmarks, picked greedily, bring this kernel to a few hundred numbers; a linear machine on them
is one weight for each subsequence, which is all that scoring needs.

Labels belong to documents. A sentence of a clean document is clean; of a toxic document the
sentence with the highest score is taken as toxic, by its highest word, and this choice is
repeated with each machine. A text scores by its highest word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import cycle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.llm.text import chunks

DECAY = 0.6
# Characters that a subsequence spans at most.
SPAN = 6
# Longer words are cut into windows of this many characters that overlap by half.
WINDOW = 24
LANDMARKS = 384
RIDGE = 1e-6
# A word is toxic at first if it stands so many standard errors, and so many times as often, in
# toxic documents.
FAR = 3.0
RATIO = 4.0
# Weight of a padded form of a toxic word, of the word's own.
PADDED = 0.1
# Share of the toxic documents that must speak for a word besides its own.
SUPPORT = 0.01
# Labelled documents the machine is fitted on, about, of each label; chosen by a hash of the id.
FIT_TOXIC = 4000
FIT_CLEAN = 8000
# Clean words of a fit: those of the highest score and others by hash; and how often to choose.
FIT_WORDS = 4000
ROUNDS = 2
THRESHOLD = 0.3
# Words whose scores a task remembers.
REMEMBERED = 200_000

# symbols: 0 none, 1 edge of a word, a-z, 0-9, and 25 classes of other characters
_SYMBOL = np.array([2 + c - 97 if 97 <= c <= 122 else 28 + c - 48 if 48 <= c <= 57
                    else 38 + c % 25 for c in range(128)], np.int32)
CODES = 1 << 18
_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def tokens_of(text: str | None) -> list[str]:
    """Lower-cased runs without blanks, and runs of three single characters or more as one."""
    raw = text.lower().split() if text else []
    single = [k for k, t in enumerate(raw) if len(t) == 1 and t.isalnum()]
    if len(single) < 3:
        return raw
    runs: list[list[int]] = [[]]
    for k in single:
        if runs[-1] and runs[-1][-1] + 1 != k:
            runs.append([])
        runs[-1].append(k)
    return raw + ["".join(raw[r[0] : r[-1] + 1]) for r in runs if len(r) > 2]


def units_of(token: str) -> list[str]:
    """The token without outer punctuation, and also without inner; long ones in windows."""
    word = _EDGES.sub("", token)
    plain = _INNER.sub("", word)
    half = WINDOW // 2
    return [w[k : k + WINDOW] for w in ([word] if plain == word else [word, plain]) if w
            for k in range(0, max(1, len(w) - half), half)]


@dataclass
class Alike:
    """Words of one length: their places, subsequence codes, each code's weight, their lengths."""

    at: np.ndarray
    codes: np.ndarray
    weights: np.ndarray
    size: np.ndarray


def coded(words: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Places, codes and each code's weight of the words of one length."""
    places: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        places.setdefault(len(w), []).append(k)
    for length, at in places.items():
        text = "".join([words[k] for k in at]).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(text, "<u4").reshape(len(at), length)
        x = np.ones((len(at), length + 2), np.int32)
        x[:, 1:-1] = np.where(points < 128, _SYMBOL[np.minimum(points, 127)], 38 + points % 25)
        n = length + 2
        steps = [(a, b) for a, b in _STEPS if b < n]
        codes = np.concatenate([x[:, : n - b] << 12 | x[:, a : n - b + a] << 6 | x[:, b:]
                                for a, b in steps], axis=1)
        yield at, codes, np.concatenate([np.full(n - b, DECAY ** (b + 1)) for _, b in steps])


def subsequences(words: list[str]) -> Iterator[Alike]:
    """Codes of all words, by length."""
    for at, codes, weights in coded(words):
        order = np.argsort(codes, axis=1)
        flat = (np.take_along_axis(codes, order, 1) + (np.arange(len(at)) * CODES)[:, None]).ravel()
        start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        sums = np.add.reduceat(weights[order].ravel(), start) ** 2
        rows = np.searchsorted(start, np.arange(len(at)) * codes.shape[1])
        yield Alike(np.array(at), codes, weights, np.sqrt(np.add.reduceat(sums, rows)))


def linear(words: list[str], weight: np.ndarray) -> np.ndarray:
    """Sum of the words' scaled subsequences times a weight for each code."""
    out = np.zeros(len(words))
    for a in subsequences(words):
        out[a.at] = (weight[a.codes] @ a.weights) / a.size
    return out


def spread(words: list[str], factors: np.ndarray) -> np.ndarray:
    """Weights by code of a sum of the words' scaled subsequences times factors."""
    out = np.zeros(CODES)
    for a in subsequences(words):
        part = (factors[a.at] / a.size)[:, None] * a.weights
        out += np.bincount(a.codes.ravel(), part.ravel(), CODES)
    return out


def kernel(words: list[str], landmarks: list[str], step: int = 2048) -> np.ndarray:
    """Likeness (0 to 1) of each word to each landmark."""
    table = {}
    for j, z in enumerate(landmarks):
        for code in np.flatnonzero(line := spread([z], np.ones(1))):
            table.setdefault(int(code), {})[j] = line[code]
    place = np.zeros(CODES, np.int32)
    values = np.zeros((len(table) + 1, len(landmarks)))
    for k, (code, row) in enumerate(table.items(), 1):
        place[code] = k
        for j, v in row.items():
            values[k, j] = v
    out = np.zeros((len(words), len(landmarks)))
    for lo in range(0, len(words), step):
        for a in subsequences(words[lo : lo + step]):
            total = np.zeros((len(a.at), len(landmarks)))
            for c, w in enumerate(a.weights):
                total += w * values[place[a.codes[:, c]]]
            out[lo + a.at] = total / a.size[:, None]
    return out


def pick_landmarks(words: list[str], m: int) -> list[str]:
    """Words chosen one by one, each the least explained by those before (pivoted Cholesky)."""
    chosen: list[str] = []
    left = np.ones(len(words))
    factor = np.zeros((len(words), min(m, len(words))))
    for j in range(factor.shape[1]):
        best = int(np.argmax(left))
        if left[best] < 1e-3:
            break
        column = linear(words, spread([words[best]], np.ones(1)))
        line = (column - factor[:, :j] @ factor[best, :j]) / math.sqrt(left[best])
        factor[:, j] = line
        left = np.maximum(left - line * line, 0)
        left[best] = 0
        chosen.append(words[best])
    return chosen


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE,
          rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by damped Newton steps; y is 1 or -1."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = weight / weight.sum()
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-9

    def loss(w: np.ndarray) -> float:
        return weight @ np.maximum(0, 1 - y * (x @ w)) ** 2 + keep @ (w * w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        active = y * (x @ w) < 1
        part = x[active]
        left = part.T @ (part * weight[active][:, None]) + np.diag(keep)
        step = np.linalg.solve(left, part.T @ (weight[active] * y[active])) - w
        size = 1.0
        while (after := loss(w + size * step)) > now and size > 1e-4:
            size /= 2
        if after >= now * (1 - 1e-7):
            break
        w, now = w + size * step, after
    return w[:-1], float(w[-1])


def calibrate(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from values to chances, with smoothed labels."""
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    goal = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([value, np.ones(len(value))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - goal)) + 1e-4 * w
        bend = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1, 2 / np.abs(step).max(initial=1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


@dataclass
class Model:
    """A weight for each subsequence code, and the curve from the highest word to a chance.

    Without weights every text has the chance base."""

    weight: np.ndarray | None = None
    bias: float = 0.0
    curve: tuple[float, float] = (1.0, 0.0)
    base: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def learn(self, tokens: set[str]) -> None:
        """Make the values of tokens known."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        missing = [t for t in tokens if t not in self.known]
        parts = [units_of(t) for t in missing]
        units = list({u for p in parts for u in p})
        value = dict(zip(units, (linear(units, self.weight) + self.bias).tolist(), strict=True))
        for t, p in zip(missing, parts, strict=True):
            self.known[t] = max(map(value.__getitem__, p), default=-math.inf)

    def values(self, tokens: list[list[str]]) -> list[float]:
        """The highest word's value of each list; minus infinity without a word."""
        self.learn(set().union(*tokens))
        get = self.known.__getitem__
        return [max(map(get, set(t)), default=-math.inf) for t in tokens]

    def chance(self, value: float) -> float:
        if value == -math.inf:
            return 0.0
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * value + b))))

    def spans(self, text: str, least: float) -> list[tuple[int, int, float]]:
        """(start, end, score) of the sentences of a score of least or more; code points."""
        cuts = [0, *(x for m in _SENTENCE.finditer(text) for x in m.span()), len(text)]
        ends = list(zip(cuts[::2], cuts[1::2], strict=True))
        found = self.values([tokens_of(text[a:b]) for a, b in ends])
        return [(a, b, s) for (a, b), v in zip(ends, found, strict=True)
                if (s := self.chance(v)) >= least]


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word."""
    count: list[Counter] = [Counter(), Counter()]
    for batch in batches:
        for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic")), strict=True):
            count[toxic].update({u for t in set(tokens_of(text)) for u in units_of(t)})
    words = list(count[0] | count[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in count)],
        names=["word", "clean", "toxic"])


def _witnesses(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The highest word of each sentence of clean texts; of toxic ones, those on the toxic side,
    or else that of the highest sentence."""
    best: list[Counter] = [Counter(), Counter()]
    value: dict[str, float] = {}
    for batch in batches:
        texts = [[[u for t in set(tokens_of(s)) for u in units_of(t)]
                  for s in _SENTENCE.split(text or "")] for text in batch.column("text").to_pylist()]
        model.learn({u for sentences in texts for s in sentences for u in s})
        for sentences, toxic in zip(texts, batch.column("toxic").to_pylist(), strict=True):
            top = [max((model.known[u], u) for u in s) for s in sentences if s]
            if toxic and top:
                top = [x for x in top if x[0] > 0] or [max(top)]
            for v, u in top:
                best[toxic][u] += 1
                value[u] = v
        model.known.clear()
    rows = [(u, t, n, value[u]) for t, found in enumerate(best) for u, n in found.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in
         enumerate((pa.string(), pa.int32(), pa.int64(), pa.float64()))],
        names=["word", "toxic", "n", "value"])


def supported(words: dict[str, int]) -> dict[str, int]:
    """The counted words that are often there or like enough others, not those of one odd text.

    What speaks for a word are its other places and, by the square of the likeness, the places
    of others, measured on up to 2 x LANDMARKS of the words."""
    order = sorted(words, key=lambda w: (-words[w], w))
    rest = order[LANDMARKS:]
    some = order[:LANDMARKS] + rest[:: max(1, -(-len(rest) // LANDMARKS))]
    share = sum(words.values()) / max(1, sum(words[w] for w in some))
    near = kernel(list(words), some) ** 2 @ np.array([words[w] * share for w in some], np.float64)
    own = {w: share for w in some}
    return {w: n for (w, n), v in zip(words.items(), near, strict=True)
            if v - own.get(w, 0) >= SUPPORT * sum(words.values())}


def padded(word: str) -> list[str]:
    """The word with a character put in at each inner place that is not near an end."""
    return [word[:k] + c + word[k:] for k, c in zip(range(2, len(word) - 1), cycle("x*-"))
            ] if 4 < len(word) < WINDOW else []


def _machine(toxic: dict[str, int], clean: dict[str, int], documents: int, share: float
             ) -> tuple[np.ndarray, float]:
    """Weights by code and bias of the machine that parts two sets of counted words.

    documents is the number of toxic ones, share their number for each clean one. Padded forms
    of the toxic words are toxic too, with a smaller weight."""
    toxic = supported(toxic)
    # the words of a toxic document share its weight
    scale = documents / max(1, sum(toxic.values()))
    toxic = {w: n * scale for w, n in toxic.items()}
    for word, n in sorted(toxic.items(), key=lambda x: (-x[1], x[0]))[:LANDMARKS]:
        for gapped in padded(word):
            if gapped not in clean:
                toxic.setdefault(gapped, PADDED * n)
    words = [*toxic, *clean]
    if not toxic or not clean:
        return np.zeros(CODES, np.float32), -1.0
    often = sorted(toxic, key=lambda w: (-toxic[w], w))[: 4 * LANDMARKS]
    landmarks = pick_landmarks(often, LANDMARKS // 2)
    near = [w for w in list(clean)[: 4 * LANDMARKS] if w not in toxic]
    landmarks += pick_landmarks(near, LANDMARKS - len(landmarks))
    value, axes = np.linalg.eigh(kernel(landmarks, landmarks))
    root = axes / np.sqrt(np.maximum(value, 1e-4)) @ axes.T
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    n = np.array([*(c / share for c in toxic.values()), *clean.values()], np.float64)
    w, bias = train(kernel(words, landmarks) @ root, y, n)
    return spread(landmarks, root @ w).astype(np.float32), bias


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", toxic: int = FIT_TOXIC, clean: int = FIT_CLEAN) -> Model:
    """Fit on the texts of docs whose id has a label of 1 (toxic) or 0.

    About toxic and clean rows of each label are taken by a hash of the id, which bounds the fit
    whatever the tables' size; several labels of an id count as the highest. A fifth of them set
    the curve, the others the machine. Spark counts and chooses words; the driver
    gets at most about toxic + (3 + ROUNDS) x FIT_WORDS words. Null texts are empty;
    other labels are left out. Without rows of both labels the model gives every text the share
    of toxic ones. Runs jobs.
    """
    spark = docs.sparkSession
    mark = F.when(F.col(f"`{label_col}`").isin(0, 1), F.col(f"`{label_col}`").cast("int"))
    rows = labels.select(F.col(f"`{id_col}`").alias("id"), mark.alias("toxic"))
    rows = rows.where("id is not null and toxic is not null")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    base = n.get(1, 0) / max(1, sum(n.values()))
    if len(n) < 2:
        return Model(base=base)
    share = {t: min(1.0, most / n[t]) for t, most in ((0, clean), (1, toxic))}
    line = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 32)) / float(1 << 32)
    # bounded by toxic and clean, so it may be sent to the texts
    chosen = rows.where(line < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    chosen = F.broadcast(chosen.groupBy("id").agg(F.max("toxic").alias("toxic")))
    sample = texts.join(chosen, "id").withColumn(
        "fold", F.pmod(F.xxhash64("id", F.lit(23)), F.lit(5))).repartition("id").persist()
    learn = sample.where("fold <> 0").select("text", "toxic")
    size = {r["toxic"]: r["count"] for r in learn.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return Model(base=base)
    held = learn.mapInArrow(_held, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).persist()
    # at first a word is toxic if its share of toxic documents is far above that of clean ones
    both = (F.col("clean") + F.col("toxic")) / float(size[0] + size[1])
    above = F.col("toxic") / size[1] - F.col("clean") / size[0]
    far = above / F.sqrt(both * (1 / size[0] + 1 / size[1]))
    much = F.col("toxic") * size[0] >= RATIO * F.col("clean") * size[1]
    first = held.where((F.col("toxic") > 1) & (far >= FAR) & much).orderBy(F.desc(far), "word")
    sure = {r["word"]: r["toxic"] for r in first.limit(FIT_WORDS).collect()}
    others = held.where("clean > 0").select("word", F.col("clean").alias("n"))
    often = others.orderBy(F.desc("n"), "word").limit(FIT_WORDS).collect()
    mixed = others.orderBy(F.xxhash64("word", F.lit(3)), "word").limit(FIT_WORDS).collect()
    positives = dict(sure)
    negatives = {r["word"]: r["n"] for r in [*often, *mixed] if r["word"] not in positives}
    hard: dict[str, int] = {}
    model = Model(*_machine(positives, negatives, size[1], size[1] / size[0]))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        seen = learn.mapInArrow(lambda b, s=shared: _witnesses(b, s.value),
                                "word string, toxic int, n long, value double")
        seen = seen.groupBy("word", "toxic").agg(F.sum("n").alias("n"), F.max("value").alias("value"))
        seen = seen.persist()
        # a document whose highest word is well on the clean side shows nothing
        shown = seen.where("toxic = 1 and value > -1").select("word", "n")
        shown = shown.join(held.select("word", "clean", much.alias("much")), "word").collect()
        positives = {**{r["word"]: r["n"] for r in shown if r["much"]}, **sure}
        # words that were hard for an earlier machine stay
        hard.update({r["word"]: r["clean"] for r in shown if not r["much"]})
        near = seen.where("toxic = 0").orderBy(F.desc("value"), "word").limit(FIT_WORDS)
        hard.update({r["word"]: r["n"] for r in near.collect()})
        seen.unpersist()
        shared.destroy()
        model = Model(*_machine(positives, {w: n for w, n in {**hard, **negatives}.items()
                                            if w not in positives},
                                size[1], size[1] / size[0]))
    held.unpersist()
    shared = spark.sparkContext.broadcast(model)
    value = sample.where("fold = 0").select(_highest(shared)("text").alias("value"), "toxic")
    value = value.where("value is not null").collect()
    sample.unpersist()
    v, y = (np.array([r[k] for r in value], np.float64) for k in (0, 1))
    if len(set(y)) < 2:
        curve = (4.0, 0.0)
    else:
        curve = calibrate(v, y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    return Model(model.weight, model.bias, curve, base)


def _highest(shared):
    """The value of the highest word, null without one."""

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in texts:
            found = [v for part in chunks(batch.to_pylist())
                     for v in model.values([tokens_of(t) for t in part])]
            yield pa.array([None if v == -math.inf else v for v in found], pa.float64())
        model.known.clear()

    return run.asNondeterministic()


def score(text: Column, model: Model, spark, least: float = THRESHOLD) -> Column:
    """Struct of score (0 to 1, higher: toxic likelier) and spans: start, end and score of the
    sentences with a score of least or more, in code points, end exclusive.

    Whole texts are read. Null texts and texts without a word score 0 and have no spans; equal
    texts score alike. The model is of a fixed size and sent to each task.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])

    @F.arrow_udf("score double, spans array<struct<start:long,end:long,score:double>>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in texts:
            out = []
            for part in chunks(batch.to_pylist()):
                if model.weight is None:
                    out += [{"score": model.base, "spans": []} for _ in part]
                    continue
                for t, v in zip(part, model.values([tokens_of(t) for t in part]), strict=True):
                    s = model.chance(v)
                    spans = model.spans(t, least) if s >= least and t else []
                    out.append({"score": s, "spans": [dict(zip(("start", "end", "score"), x,
                                                               strict=True)) for x in spans]})
            yield pa.array(out, kind)
        model.known.clear()

    return run.asNondeterministic()(text)
