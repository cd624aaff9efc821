"""Personal data in texts: generators propose spans, boosted trees score them.

Everything is a column expression over one row, so texts are never shuffled and no Python runs
on the executors. Only the counts of feature values, whose number is bounded, reach the driver,
where the trees are grown.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<start:int,end:int,hit:string>>"
# Base formats. A quantifier that takes all it can (++) and a look at the character before give
# the matches of the plain patterns in time linear in the text:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wider formats that propose spans.
WIDE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
             r"(?:\.[A-Za-z0-9-]++| ?(?:\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.-][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+?\(?[0-9]{1,4}\)?[ .-]{0,2})?\(?[0-9]{2,4}\)?[ .-]"
             r"[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
}
# What a text with a match must hold; the rest is not searched.
GATES = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9][.-][0-9]", "card": r"[0-9][0-9 .-]{11}",
         "phone": r"\+[0-9]|[0-9][)]?[ .-][0-9]{3}"}
# Words before a span that speak of its kind.
WORDS = {"email": r"(?i)e-?mail|contact|write|@", "ip": r"(?i)\bip\b|host|server|addr",
         "card": r"(?i)card|visa|master|credit|pay", "phone": r"(?i)tel|phone|call|fax|mobil"}
CONTEXT = 24
TREES = 24
RATE = 0.3
# Share of right spans, and least number of them, that a threshold must show on held-out texts.
PRECISION = 0.95
LEAST_RIGHT = 20
FEATURES = ("kind", "digits", "marks", "sound", "before", "after", "word", "distinct")
_BLOCK = 64


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once however often then uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, b: a + b)


def matches(text: Column, pattern: str) -> Column:
    """SPAN of the leftmost matches that do not overlap; places are code points, end exclusive.

    Gaps and matches alternate, so a match starts where the lengths before it end. These are
    summed by blocks, so that a text with many matches does not take the square of them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.split(text, pattern, -1), found,
                       lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))

    def spans(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda x: x["gap"] + F.coalesce(F.length(x["hit"]), F.lit(0)))

        def place(lengths: Column, blocks: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                before = _total(F.slice(blocks, F.lit(1), block)) + _total(
                    F.slice(lengths, block * _BLOCK + 1, i % _BLOCK))
                start = before + x["gap"]
                return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"),
                                x["hit"].alias("hit"))

            return F.transform(F.slice(pairs, F.lit(1), F.size(pairs) - 1), one)

        def summed(lengths: Column) -> Column:
            count = F.ceil(F.size(lengths) / _BLOCK).cast("int")
            blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: _total(
                F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
            return let(blocks, lambda b: place(lengths, b))

        return let(lengths, summed)

    return let(pairs, spans)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits of hit pass the check: every second from the right is doubled."""
    def weigh(d: Column, i: Column) -> Column:
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    return _total(F.transform(F.split(F.reverse(_digits(hit)), ""), weigh)) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    """Checks that a base match must pass."""
    size = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return (size >= 16) & (size <= 19) & luhn(hit)
    if kind == "phone":
        return (size >= 8) & (size <= 15)
    return F.lit(True)


def _gated(text: Column, kind: str, found: Column) -> Column:
    return F.when(text.rlike(GATES[kind]), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column, kind: str) -> Column:
    """SPAN of the base matches of a kind; text must not be null."""
    found = matches(text, BASE[kind])
    return _gated(text, kind, F.filter(found, lambda s: valid(kind, s["hit"])))


def _sound(kind: str, hit: Column) -> Column:
    """What a proposal of the kind must be whichever way it is written: no +, @ or separator and
    no base length counts here."""
    if kind == "email":
        return hit.rlike(r"(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z]{2}")
    if kind == "ip":
        return valid("ip", F.translate(hit, "-", "."))
    if kind == "card":
        return luhn(hit)
    return F.length(_digits(hit)).between(8, 15)


def _beside(char: Column) -> Column:
    return F.when(char.rlike(r"^[\p{L}\p{N}]"), 1).when(char.rlike(r"^[^\s]"), 2).otherwise(0)


def proposals(text: Column, kind: str) -> Column:
    """Proposed spans with FEATURES, each a small number.

    The marks by which base formats are told (+, @, which separators, 16 digits or 13) are no
    features, so a form without them is judged by its check digit, lengths and context."""
    def describe(s: Column) -> Column:
        hit, digits = s["hit"], _digits(s["hit"])
        ahead = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)),
                            F.least(s["start"], F.lit(CONTEXT)))
        kinds = F.size(F.array_distinct(F.split(digits, "")))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            F.least(F.floor(F.length(digits) / 2), F.lit(6)).cast("int").alias("digits"),
            F.least(F.length(F.regexp_replace(hit, r"[^ .()\[\]-]", "")), F.lit(2)).alias("marks"),
            _sound(kind, hit).cast("int").alias("sound"),
            _beside(F.substring(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0)))
            .alias("before"),
            _beside(F.substring(text, s["end"] + 1, F.lit(1))).alias("after"),
            ahead.rlike(WORDS[kind]).cast("int").alias("word"),
            F.least(F.floor(kinds / 2), F.lit(5)).cast("int").alias("distinct"),
        )

    fields = "start:int,end:int," + ",".join(f"{f}:int" for f in FEATURES)
    found = F.transform(matches(text, WIDE[kind]), describe)
    return F.when(text.rlike(GATES[kind]), found).otherwise(
        F.array().cast(f"array<struct<{fields}>>"))


def _overlaps(s: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


class Trees:
    """Boosted trees of two levels on FEATURES, and a threshold for each kind."""

    def __init__(self, trees: list, bias: float, least: dict[str, float]):
        self.trees, self.bias, self.least = trees, bias, least

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for f, t, sides in self.trees:
            for low, (g, u, a, b) in zip((x[:, f] <= t, x[:, f] > t), sides, strict=True):
                out += np.where(low, np.where(x[:, g] <= u, a, b), 0.0)
        return out

    def column(self, s: Column) -> Column:
        """The score of a proposal."""
        out = F.lit(self.bias)
        for f, t, ((g, u, a, b), (h, v, c, d)) in self.trees:
            left = F.when(s[FEATURES[g]] <= u, a).otherwise(b)
            right = F.when(s[FEATURES[h]] <= v, c).otherwise(d)
            out = out + F.when(s[FEATURES[f]] <= t, left).otherwise(right)
        return out

    def wanted(self, s: Column, kind: str) -> Column:
        least = self.least.get(kind)
        return F.lit(False) if least is None else self.column(s) >= least


def _split(x, grad, hess, rows):
    """Best (feature, threshold) of the rows by gain of the logistic loss, or None."""
    best, choice = 1e-9, None
    total = grad[rows].sum() ** 2 / (hess[rows].sum() + 1)
    for f in range(x.shape[1]):
        for t in np.unique(x[rows, f])[:-1]:
            low = rows & (x[:, f] <= t)
            high = rows & ~low
            gain = (grad[low].sum() ** 2 / (hess[low].sum() + 1)
                    + grad[high].sum() ** 2 / (hess[high].sum() + 1) - total)
            if gain > best:
                best, choice = gain, (f, float(t))
    return choice


def grow(x: np.ndarray, right: np.ndarray, wrong: np.ndarray, trees: int = TREES,
         rate: float = RATE) -> tuple[list, float]:
    """Gradient boosting on cells of equal features with counts of right and wrong."""
    n = right + wrong
    bias = float(np.log((right.sum() + 1) / (wrong.sum() + 1)))
    score, out = np.full(len(x), bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = right - n * p, n * p * (1 - p)
        top = _split(x, grad, hess, np.ones(len(x), bool))
        if top is None:
            break
        f, t = top
        sides = []
        for rows in (x[:, f] <= t, x[:, f] > t):
            g, u = _split(x, grad, hess, rows) or (f, t)
            leaves = []
            for leaf in (rows & (x[:, g] <= u), rows & (x[:, g] > u)):
                step = float(rate * grad[leaf].sum() / (hess[leaf].sum() + 1))
                score[leaf] += step
                leaves.append(step)
            sides.append((g, u, *leaves))
        out.append((f, t, tuple(sides)))
    return out, bias


def fit(docs: DataFrame, text_col: str = "text") -> Trees:
    """Trees fitted on the texts themselves: a proposal is right if a base match overlaps it.

    Base matches stand for all of their kind: what makes them base is hidden from the features
    (see proposals), so forms that no base pattern takes score like the base spans they resemble.
    All texts are used; by a hash, half of them grow the trees, the others set each kind's
    threshold: the least score from which on PRECISION of the proposals are right. A kind without
    such a score adds no spans. Runs a job.
    """
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    texts = texts.withColumn("h", F.xxhash64("text", F.lit(41)))
    gate = F.lit(False)
    for kind in KINDS:
        gate = gate | F.col("text").rlike(GATES[kind])
    texts = texts.where(gate)
    text = F.col("text")

    def judged(kind: str) -> Column:
        proposed = proposals(text, kind)
        return let(base_spans(text, kind), lambda b: F.transform(
            proposed, lambda s: s.withField("right", _overlaps(s, b).cast("int"))))

    found = [judged(k) for k in KINDS]
    rows = texts.select((F.shiftrightunsigned("h", 40) % 2).cast("int").alias("fold"),
                        F.explode(F.concat(*found)).alias("s"))
    cells = rows.groupBy("fold", *[F.col(f"s.{f}").alias(f) for f in FEATURES]).agg(
        F.sum("s.right").alias("right"), F.count("*").alias("n")).collect()
    table = np.array([[r["fold"], *[r[f] for f in FEATURES], r["right"], r["n"]] for r in cells],
                     float).reshape(-1, len(FEATURES) + 3)
    table = table[np.lexsort(table.T)]
    x, right, n = table[:, 1:-2], table[:, -2], table[:, -1]
    train = table[:, 0] == 0
    trees, bias = grow(x[train], right[train], (n - right)[train])
    model = Trees(trees, bias, {})
    score = model.score(x)
    for k, kind in enumerate(KINDS):
        held = ~train & (x[:, 0] == k)
        order = np.argsort(-score[held], kind="stable")
        s, hits, seen = score[held][order], np.cumsum(right[held][order]), np.cumsum(n[held][order])
        last = np.append(s[1:] < s[:-1], True) if len(s) else np.zeros(0, bool)
        good = np.flatnonzero(last & (hits >= PRECISION * seen) & (hits >= LEAST_RIGHT))
        if len(good):
            model.least[kind] = float(s[good[-1]]) - 1e-9
    return model


def find_spans(text: Column, model: Trees) -> Column:
    """Struct of base and all: for each kind SPAN-like arrays of (start, end), in order.

    all has the base spans and the proposals that the trees select and that overlap no base
    span of their kind. A null text has none.
    """
    whole = F.coalesce(text, F.lit(""))

    def both(kind: str) -> Column:
        def merged(base: Column) -> Column:
            plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"),
                                                         s["end"].alias("end")))
            if kind not in model.least:
                return F.struct(plain.alias("base"), plain.alias("all"))
            more = F.filter(proposals(whole, kind),
                            lambda s: model.wanted(s, kind) & ~_overlaps(s, base))
            more = F.transform(more, lambda s: F.struct(s["start"].alias("start"),
                                                        s["end"].alias("end")))
            return F.struct(plain.alias("base"), F.array_sort(F.concat(plain, more)).alias("all"))

        return let(base_spans(whole, kind), merged)

    return F.struct(*[both(k).alias(k) for k in KINDS])


def spans_text(found: Column, which: str) -> Column:
    """kind:start:end of the base or all spans, by kind and start, joined by commas."""
    def named(kind: str) -> Column:
        return F.transform(found[kind][which], lambda s: F.concat_ws(
            ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[named(k) for k in KINDS]), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; null stays null.

    Where spans overlap the kind of the first (of one start, the first by KINDS) stands for
    all. The text is read once from each span to the next.
    """
    def marks(n: int, kind: str) -> Column:
        return F.transform(found[kind]["all"], lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"),
            F.lit(f"<{kind.upper()}>").alias("mark")))

    marked = F.concat(*[marks(n, k) for n, k in enumerate(KINDS)])

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(new, F.concat(a["out"], gap, s["mark"])).otherwise(a["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.array_sort(marked), start, step, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    some = F.lit(False)
    for k in KINDS:
        some = some | (F.size(found[k]["all"]) > 0)
    return F.when(some, done).otherwise(text)


def redact_documents(docs: DataFrame, model: Trees, text_col: str = "text",
                     size_col: str = "n_chars") -> DataFrame:
    """docs with personal data in text_col replaced, and size_col, if there, the new length.

    All other columns, and rows without such data, are returned as they are.
    """
    text = F.col(f"`{text_col}`")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), text.alias("text"))
    rows = rows.withColumn("new", let(find_spans(F.col("text"), model),
                                      lambda f: redact(F.col("text"), f)))
    changed = ~F.col("new").eqNullSafe(F.col("text"))
    out = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == text_col:
            old = F.col("new")
        elif c == size_col:
            old = F.when(changed, F.length("new").cast(docs.schema[c].dataType)).otherwise(old)
        out.append(old.alias(c))
    return rows.select(*out)
