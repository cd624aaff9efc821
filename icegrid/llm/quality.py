"""Document quality: a classifier's evidence shrunk towards its site by empirical Bayes.

Three levels: all documents, hosts, and paths of a host. Each level's mean score is the prior
of the next, with a strength estimated from how much the means differ beyond chance, so a site
with few documents stays near the level above it.

Documents have no URL. By default the column source stands for the host and lang for the path,
as these are the only columns that group documents: a path's posterior is then one by language
within a source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icegrid.operators.skew import attach
from icegrid.session import scratch_dir

# Labelled documents that the classifier is fitted on, about; chosen by a hash of the id.
FIT_DOCUMENTS = 20_000
RIDGE = 1.0
# Bounds of a prior's strength, in documents.
STRENGTH = (1.0, 1e4)
KEEP = 0.5
# A document's own evidence counts at most this many nats either way.
MOST = 12.0

FEATURES = ["log_bytes", "letters", "upper", "digits", "marks", "blanks", "word_bytes",
            "words_distinct", "lines_distinct", "line_bytes", "bracket_marks"]
_LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha())
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"#$%&*!|~^=<>@_\\"
_BRACKETS = b"{}[]();"
_BLANKS = b" \t\r\n\x0b\x0c"


def features_of(text: str | None) -> list[float]:
    """FEATURES of a text; all 0 for null and empty ones."""
    data = text.encode("utf-8", "replace") if text else b""
    n = len(data)
    if not n:
        return [0.0] * len(FEATURES)
    words, lines = data.split(), data.split(b"\n")

    def share(of: bytes) -> float:
        return 1 - len(data.translate(None, of)) / n

    return [math.log(n), share(_LETTERS), share(_UPPER), share(_DIGITS), share(_MARKS),
            share(_BLANKS), math.log1p(n / max(1, len(words))),
            len(set(words)) / max(1, len(words)) * math.log1p(len(words)),
            len(set(lines)) / len(lines), math.log1p(n / len(lines)), share(_BRACKETS)]


def _features(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            yield pd.DataFrame([features_of(t) for t in series], columns=FEATURES, dtype=float)

    return run.asNondeterministic()(text)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30):
    """(weights, intercept) of ridge logistic regression by Newton steps; zeros without rows."""
    if not len(y):
        return np.zeros(x.shape[1]), 0.0
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(y))])
    w = np.zeros(z.shape[1])
    pull = np.full(len(w), ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(hess, z.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ centre)


def _strength(mean: float, rows: float, groups: float, squares: float, between: float) -> float:
    """Documents that a prior is worth, by moments.

    between is the sum of n (m - prior)^2 over groups and squares that of n^2; with spread v of
    true means it is expected to be groups * mean (1 - mean) + rows * v.
    """
    low, high = STRENGTH
    chance = max(mean * (1 - mean), 1e-9)
    spread = (between - groups * chance) / max(rows, 1.0)
    return min(high, max(low, chance / spread - 1)) if spread > 1e-12 else high


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", host_col: str = "source", path_col: str = "lang",
                 label_col: str = "quality", documents: int = FIT_DOCUMENTS) -> DataFrame:
    """Quality of every row: id_col, doc_score, host_mean, path_mean, prior, quality, kept.

    labels has id_col and label_col (0 or 1); null labels are left out and a repeated id counts
    with each. About documents of the labelled rows, chosen by hash, are fitted on; all counts
    and means are over all rows of docs. doc_score is the classifier's probability. host_mean
    is that of the host and path_mean that of the path in the host, both shrunk; prior is
    path_mean without the row's own part. quality adds the log odds of doc_score and what prior
    adds to the overall mean; kept is quality >= KEEP. Null hosts and paths are values like any
    other. Without labels every score is one half and all rows are kept. Null and empty texts
    are scored by features of 0. Other columns are not read. Runs jobs.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "quality")
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"),
                       F.col(path_col).alias("path"),
                       _features(F.col(text_col)).alias("x"))
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)

    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    marks = marks.where("y is not null and id is not null")
    total = marks.count()
    if total > documents:
        share = int(documents / total * (1 << 32))
        marks = marks.where(F.pmod(F.xxhash64("id", F.lit(23)), F.lit(1 << 32)) < share)
    sample = np.array([[*r["x"], r["y"]] for r in rows.join(marks, "id").select("x", "y")
                       .toLocalIterator()]).reshape(-1, len(FEATURES) + 1)
    weights, intercept = fit_logistic(sample[:, :-1], sample[:, -1])
    score = F.lit(intercept)
    for name, w in zip(FEATURES, weights, strict=True):
        score = score + F.col(f"x.{name}") * float(w)
    score = F.least(F.greatest(score, F.lit(-MOST)), F.lit(MOST))
    rows = rows.select("id", "host", "path", (1 / (1 + F.exp(-score))).alias("p"))

    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    rows_n, sum_p = hosts.agg(F.sum("hn"), F.sum("hs")).first()
    mean = (sum_p / rows_n) if rows_n else 0.5

    def moments(table: DataFrame, n: str, s: str, prior: Column) -> float:
        off = F.col(s) / F.col(n) - prior
        got = table.agg(F.sum(n), F.count("*"), F.sum(F.col(n) * F.col(n)),
                        F.sum(F.col(n) * off * off)).first()
        return _strength(mean, *[float(v or 0) for v in got])

    k = moments(hosts, "hn", "hs", F.lit(mean))
    hosts = hosts.select("host", ((F.col("hs") + k * mean) / (F.col("hn") + k)).alias("host_mean"))
    paths = attach(paths, hosts, ["host"])
    j = moments(paths, "n", "s", F.col("host_mean"))
    out = attach(rows, paths, ["host", "path"])
    base = F.col("host_mean") * j
    prior = (F.col("s") - F.col("p") + base) / (F.col("n") - 1 + j)
    odds = _logit(F.col("p")) + _logit(F.col("prior")) - _logit(F.lit(float(mean)))
    return out.select(
        F.col("id").alias("i"), "p", "host_mean",
        ((F.col("s") + base) / (F.col("n") + j)).alias("path_mean"), prior.alias("prior"),
    ).withColumn("quality", 1 / (1 + F.exp(-odds))).select(
        F.col("i").alias(id_col), F.col("p").alias("doc_score"), "host_mean", "path_mean",
        "prior", "quality", (F.col("quality") >= KEEP - 1e-9).alias("kept"),
    )
