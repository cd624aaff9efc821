"""Licence tags and notices in texts, and the value of licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from icegrid.llm.text import alnum_words, release

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases, as words.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "3 clause bsd license": "bsd-3",
    "bsd 3 clause license": "bsd-3",
    "2 clause bsd license": "bsd-2",
    "bsd 2 clause license": "bsd-2",
    "isc license": "isc",
    "boost software license": "bsl",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
# How freely a text under a licence may be used, 0 to 1. Names are cut at "-" from the right
# until one is known; others count as UNKNOWN_VALUE.
VALUES = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "cc0": 1.0, "zlib": 1.0,
    "unlicense": 1.0, "public-domain": 1.0, "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6,
    "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.3, "cc-by-nc": 0.2,
    "all-rights-reserved": 0.0,
}
UNKNOWN_VALUE = 0.5
_TAGGED = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+:-]*|[()]")
_BINDING = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """A licence expression in postfix order, by two stacks: with binds before and before or.

    Reading stops at the first token that cannot follow, so text after an expression on its
    line is left out; an expression without a licence gives nothing.
    """
    out: list[str] = []
    stack: list[str] = []
    want_name = True
    last = ""
    for token in _TOKEN.findall(expression):
        before, last = last, token.lower()
        word = last
        if want_name:
            if word == "(":
                # with binds a name to a name
                if before == "with":
                    break
                stack.append(word)
                continue
            if word in _BINDING or word == ")":
                break
            out.append(word)
            want_name = False
        elif word == ")":
            if "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif word in _BINDING and not (word == "with" and before == ")"):
            while stack and stack[-1] != "(" and _BINDING[stack[-1]] >= _BINDING[word]:
                out.append(stack.pop())
            stack.append(word)
            want_name = True
        else:
            break
    if want_name:
        # cut off: the last operator has no right side, whatever brackets follow it
        while stack and stack[-1] == "(":
            stack.pop()
        if stack:
            stack.pop()
    out += [t for t in reversed(stack) if t != "("]
    return out


def value_of(name: str) -> float:
    while name:
        if name in VALUES:
            return VALUES[name]
        name = name.rpartition("-")[0]
    return UNKNOWN_VALUE


def evaluate(tokens: list[str]) -> tuple[float, list[str]] | None:
    """(value, licences) of a postfix expression: and takes the smaller value, or the larger.

    with names an exception, which is no licence and moves the value halfway to 1.
    """
    stack: list[tuple[float, list[str]]] = []
    for token in tokens:
        if token not in _BINDING:
            stack.append((value_of(token), [token]))
            continue
        if len(stack) < 2:
            return None
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(((1 + left[0]) / 2, left[1]))
        else:
            pick = min if token == "and" else max
            stack.append((pick(left[0], right[0]), left[1] + right[1]))
    return stack[0] if len(stack) == 1 else None


class Scanner:
    def __init__(self) -> None:
        self.words = ahocorasick.Automaton()
        for phrase, label in {**BASE, **NOTICES, TAG: ""}.items():
            self.words.add_word(f" {phrase} ", (phrase, label))
        self.words.make_automaton()

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, expressions, score."""
        words = alnum_words(text)
        line = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace") if words else ""
        base, first, last = 0, None, None
        base_labels, labels, values, expressions = set(), set(), [], []
        tagged = False
        seen = at = 0
        for end, (phrase, label) in self.words.iter(line):
            if phrase in BASE:
                # blanks are counted on from the last place, as notices may be many
                start = end - len(phrase) - 1
                at += line.count(" ", seen, start) - line.count(" ", start, seen)
                seen = start
                base += 1
                first = at if first is None else min(first, at)
                last = at if last is None else max(last, at)
                base_labels.add(label)
            if phrase == TAG:
                tagged = True
            else:
                labels.add(label)
        values = [value_of(x) for x in labels]
        if tagged:
            for found in _TAGGED.findall(text):
                tokens = postfix(found)
                result = evaluate(tokens)
                if result:
                    values.append(result[0])
                    labels.update(result[1])
                    expressions.append(" ".join(tokens))
        return (len(words), base, first, last, ",".join(sorted(base_labels)),
                ",".join(sorted(labels)), expressions, float(min(values, default=0.0)))


FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, expressions array<string>, score double")


def scan_licenses(text: Column) -> Column:
    """Struct of FIELDS for a text column.

    Notice phrases and tags are found in one pass of an automaton over the words of the text,
    whose bounds are blanks, so phrases match whole words wherever they stand. Tags are then
    read in the text itself and their expressions (postfix in expressions) evaluated. n_base,
    first_word and last_word are the places of the base phrases. labels has those of all
    notices and the licences of expressions. score is the smallest value of a notice or
    expression, 0 if there is none: the freest use that all allow. A null text is empty.
    """

    @F.pandas_udf(FIELDS)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for series in texts:
            out = pd.DataFrame([scanner.scan(t) for t in series], columns=names)
            for c in ("n_words", "n_base", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out
        release()

    return run.asNondeterministic()(text)
