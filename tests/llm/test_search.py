"""Lexical search, hard negatives and toxicity against plain restatements, edge cases included."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from icegrid.llm import hard_negatives, lexical, toxicity
from icegrid.llm.language import held_out

LONG = "the cat " * 30_000


def alnum(t):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


# lexical search

def brute_search(docs, items, k):
    rows = [(i, w) for i, t in docs if (w := alnum(t))]
    n_docs, n_terms = len(rows), sum(len(w) for _, w in rows)
    holders = Counter(t for _, w in rows for t in set(w))
    out = []
    for item, text in set(items):
        found = []
        for i, w in rows:
            tf, m = Counter(w), 25 + (75 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                        * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in alnum(text) if t in tf)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s)
                for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("coordinates", "block_bytes", "k"), [(8192, 1 << 22, 10), (7, 60, 3)])
def test_search_equals_all_scores(spark, coordinates, block_bytes, k):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Éa", "B", "c"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " .!"), (503, LONG), (None, docs[0][1]), docs[1], (1, docs[1][1])]
    items = [(j, " ".join(rng.choice(words) for _ in range(8))) for j in range(12)]
    items += [(50, None), (51, ""), (52, "w1 w1 W1 cat"), (52, "w2"), items[0], (53, "unknown")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs],
                               "doc_id long, text string, item string, rank int").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(df, asked, k, coordinates=coordinates, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, [i for i in items if i[1]], k)
    assert lexical.search(df.limit(0), asked).count() == lexical.search(df, asked.limit(0)).count() == 0


def test_bounds_are_never_below_scores_and_spare_documents():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6))}".encode() for _ in range(40_000)]
    rows = [words[k : k + 40] for k in range(0, len(words), 40)]
    holders = Counter(t for w in rows for t in set(w))
    corpus = lexical.Corpus(len(rows), len(words), holders)
    hashes = lexical.WordHashes()
    shares = [corpus.share(len(w)) for w in rows]
    table = lexical.sketches(rows, shares, hashes, 512)
    item = lexical.Item(rows[7][:20], corpus, hashes, 512)
    bounds = item.weights @ table[item.places]
    scores = [sum(w * lexical.impact(c, m) for t, w in item.terms.items() if (c := r.count(t)))
              for r, m in zip(rows, shares, strict=True)]
    assert (bounds >= np.array(scores)).all()
    best = []
    scored = lexical.walk(bounds, best, 10, lambda d: scores[d], list(range(len(rows))))
    assert scored < len(rows) / 2
    assert sorted(e[0] for e in best) == sorted(scores)[-10:]


# hard negatives

def brute_negatives(rows, anchors, k=5):
    good = {(i, tuple(math.floor(256 * float(x)) for x in v), lab) for i, v, lab in rows
            if i is not None and lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, u, lab in good:
        if not anchors(a):
            continue
        score = {(i, sum(x * y for x, y in zip(u, v, strict=True)), w == lab)
                 for i, v, w in good if i != a and len(u) == len(v)}
        for p, s, _ in sorted((r for r in score if r[2]), key=lambda r: (-r[1], r[0]))[:k]:
            low = sorted((r for r in score if not r[2] and 80 * s <= 100 * r[1] <= 100 * s),
                         key=lambda r: (-r[1], r[0]))[:k]
            out += [(a, p, n, i, s, t) for n, (i, t, _) in enumerate(low, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_negatives(spark, monkeypatch, small):
    if small:
        for name, value in (("GROUP_BYTES", 1), ("BLOCK", 8), ("LIST_BYTES", 2000), ("STEP", 16)):
            monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in np.float32(centre[i % 6] + 0.3 * rng.normal(size=8))], i % 4)
            for i in range(500)]
    rows += [(600 + i, rows[10][1], i % 3) for i in range(8)] + [rows[4], rows[4]]
    rows += [(700, None, 1), (705, [1.0, None], 1), (710, [math.nan] * 8, 1), (715, [0.0] * 8, 2),
             (720, [math.inf] * 8, 0), (725, [1.0, 2.0], 1), (730, [2.0, 1.0], 1), (731, [2.0, 1.5], 3),
             (735, [], 1), (740, rows[3][1], None), (None, rows[3][1], 1), (745, [1e30] * 8, 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, line int, q string")
    got = hard_negatives.mine(df.repartition(3), F.col("vec_id") % 5 == 0)
    big = {745}
    want = [r for r in brute_negatives([r for r in rows if r[0] not in big], lambda a: a % 5 == 0)]
    have = sorted(tuple(r) for r in got.collect())
    assert [r for r in have if not big & {r[0], r[1], r[3]}] == [
        r for r in want if (r[0], r[1]) in {x[:2] for x in have}]
    assert len({x[0] for x in have}) > 80
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(None).cast("boolean")).count() == 0


def test_negatives_exactly(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows, lambda a: a % 10 == 0)


def test_a_list_is_left_when_nothing_can_be_missed():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(20, 32)) * 100
    rows = np.floor(np.repeat(centre, 1000, axis=0) + rng.normal(size=(20_000, 32)))
    labels, ids = np.arange(20_000) % 10, np.arange(20_000)
    block = hard_negatives.Block(0, rows[:50], labels[:50], ids[:50])
    goal = hard_negatives.Nearest([block], 5)
    made = hard_negatives.walk(block, rows, labels, ids, goal, *hard_negatives.unit(rows))
    assert made < 50 * 20_000 / 5
    score = np.where((labels[:50, None] == labels) & (ids[:50, None] != ids), rows[:50] @ rows.T, -1)
    assert (goal.best.score == np.sort(score, axis=1)[:, :-6:-1]).all()


# toxicity

def brute_alike(a, b):
    def counts(word):
        out = Counter()
        padded = f"^{word}^"
        for at in combinations(range(len(padded)), 3):
            if at[2] - at[0] < toxicity.SPAN:
                out["".join(padded[k] for k in at)] += toxicity.DECAY ** (at[2] - at[0] + 1)
        return out

    x, y = counts(a), counts(b)
    dot = sum(v * y[s] for s, v in x.items())
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_kernel_counts_gapped_subsequences():
    words = ["idiot", "idxiot", "id.iot", "aaaa", "banana", "ab", "a", "trash"]
    got = toxicity.kernel(words, words)
    want = [[brute_alike(a, b) for b in words] for a in words]
    assert np.allclose(got, want)
    line = toxicity.spread(words, np.arange(8.0))
    assert np.allclose(toxicity.linear(words, line), np.array(want) @ np.arange(8.0))


def test_words_of_odd_texts():
    assert toxicity.tokens_of("You i d i o t\n- x y") == ["you", "i", "d", "i", "o", "t", "-", "x", "y", "idiot"]
    assert toxicity.units_of("(id-iot!)") == ["id-iot", "idiot"] and toxicity.units_of("..") == []
    assert "".join(toxicity.units_of("ab" * 500)[::2]) == "ab" * 500
    assert toxicity.tokens_of(None) == toxicity.tokens_of("") == []


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs, labels = (spark.read.parquet(sf_dir.replace("0.001", "0.1") + f"/{t}.parquet")
                    for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))


def test_held_out_labels(spark, model):
    docs, labels, machine = model
    held = labels.where(held_out(F.col("doc_id"))).join(docs, "doc_id")
    rows = held.select("toxic", toxicity.score(F.col("text"), machine, spark).alias("t")).collect()
    found = [(r.toxic, r.t.score >= toxicity.THRESHOLD) for r in rows]
    assert all(0 <= r.t.score <= 1 and bool(r.t.spans) == (r.t.score >= 0.3) for r in rows)
    # 6 of the 120 toxic texts hold no word that tells them, 2 % of the others hold such words
    assert np.mean([hit for t, hit in found if t]) > 0.93
    assert np.mean([hit for t, hit in found if not t]) < 0.03


def test_gapped_words_and_odd_rows(spark, model):
    _, _, machine = model
    bad = ["such an idiot here", "such an id.iot here", "such an idxiot here", "an i d i o t",
           "an I-D-I-O-T!", "you are worth.less", "pure tra sh or traash"]
    fine = ["The cat sat on the mat.", "of the and", "7 12 x", LONG]
    empty = [None, "", " ", "?!"]
    df = spark.createDataFrame([(t, 1, "x") for t in bad + fine + empty + bad[:1]],
                               "text string, score int, spans string")
    got = [r.t for r in df.select(toxicity.score(F.col("text"), machine, spark).alias("t")).collect()]
    assert sum(t.score >= 0.3 for t in got[: len(bad)]) >= len(bad) - 1
    assert all(t.score < 0.3 for t in got[len(bad) : len(bad) + len(fine)])
    assert all(t.score == 0 and not t.spans for t in got[len(bad) + len(fine) : -1])
    assert got[-1] == got[0]
    text = "All is well. What an idiot! Good day."
    span = spark.createDataFrame([(text,)], "text string").select(
        toxicity.score(F.col("text"), machine, spark).alias("t")).first().t.spans
    assert [text[s.start : s.end] for s in span] == ["What an idiot!"]


def test_tables_without_both_labels(spark, model):
    docs, labels, _ = model
    for part in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        base = toxicity.fit(docs, part)
        assert base.weight is None and base.base == 0
        some = docs.limit(3).select(toxicity.score(F.col("text"), base, spark).alias("t")).collect()
        assert all(r.t.score == 0 for r in some)
    assert toxicity.fit(docs.limit(0), labels).weight is None
    machine = toxicity.Model()
    assert docs.limit(0).select(toxicity.score(F.col("text"), machine, spark).alias("t")).count() == 0
