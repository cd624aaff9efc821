"""Byte-level BPE with a segment tree over the byte positions of a piece.

A leaf of the tree holds the rank of the pair that starts at its position, joined with the
position, so the root names the leftmost pair of least rank. A merge changes three leaves: the
pair itself, the pair before, and the one that was second; their paths to the root are updated.
Short pieces of one size share an array and merge in lockstep, a long piece has its own tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from icegrid.llm.text import chunks, release

# Pieces up to this many bytes merge in lockstep, at most LOCKSTEP tree nodes at once.
SHORT = 64
LOCKSTEP = 1 << 18
# Bytes of units of text with their ids that each task remembers, about; three times at most.
REMEMBERED_BYTES = 8 << 20
# What a remembered entry takes besides its characters and ids, about.
_ENTRY = 220
_NONE = 1 << 30
_WIDTH = [1 << max(1, (n - 1).bit_length()) for n in range(SHORT + 1)]


def read_ranks(path: str) -> tuple[bytes, ...]:
    """Tokens in the order of their ranks, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tuple(tokens)


@lru_cache(maxsize=4)
def merges_of(tokens: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of token ids that merge, as sorted left * number of tokens + right, and their ranks."""
    ranks = {t: r for r, t in enumerate(tokens) if t}
    width = len(tokens)
    keys, values = [], []
    # a token of one byte never results from a merge
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                keys.append(left * width + right)
                values.append(rank)
    order = np.argsort(keys)
    return (np.append(np.array(keys, np.int64)[order], 1 << 62),
            np.append(np.array(values, np.int32)[order], np.int32(-1)))


class Remembered(dict):
    """Texts and their ids, with a count of about how many bytes they take."""

    size = 0

    def learn(self, names: list[str], values: list[bytes]) -> None:
        self.update(zip(names, values, strict=True))
        self.size += sum(map(len, names)) + sum(map(len, values)) + _ENTRY * len(names)


class Bpe:
    """Encoder of one vocabulary. Arrays of pairs are shared, no table of Python objects is built
    but the ranks."""

    def __init__(self, tokens: tuple[bytes, ...], pattern: str,
                 merges: tuple[np.ndarray, np.ndarray] | None = None):
        self.pattern = regex.compile(pattern)
        self.ranks = {t: r for r, t in enumerate(tokens) if t}
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.single < 0).any():
            raise ValueError("every byte needs a token")
        self.width = len(tokens)
        self.keys, self.values = merges or merges_of(tokens)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def _one(self, left: int, right: int) -> int:
        key = left * self.width + right
        at = self.keys.searchsorted(key)
        return int(self.values[at]) if self.keys[at] == key else -1

    def merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of 2 to width bytes; width is a power of two up to SHORT.

        The arrays of all pieces lie one after the other; positions below are places in them.
        """
        m = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8)
        ids = self.single[raw]
        start = np.repeat(np.arange(m) * width, width)
        place = np.arange(m * width)
        end = start + np.repeat(sizes, width)
        live = place < end
        after, before = place + 1, place - 1
        # leaves of piece k are at k * 2 * width + width
        tree = np.full((m, 2 * width), _NONE, np.int32)
        rank = self._rank(ids[:-1], ids[1:])
        good = (rank >= 0) & (after[:-1] < end[:-1])
        leaf = np.append(np.where(good, rank * width + (place - start)[:-1], _NONE), _NONE)
        tree[:, width:] = leaf.reshape(m, width)
        level = width
        while level > 1:
            nodes = tree[:, level : 2 * level]
            tree[:, level // 2 : level] = np.minimum(nodes[:, ::2], nodes[:, 1::2])
            level //= 2
        tree = tree.ravel()
        roots = np.flatnonzero(tree[1 :: 2 * width] < _NONE) * 2 * width
        while len(roots):
            best = tree[roots + 1].astype(np.int64)
            base = roots // 2
            at = base + best % width
            ids[at] = best // width
            second = after[at]
            third = after[second]
            first = before[at]
            live[second] = False
            after[at] = third
            stop = end[at]
            inside = third < stop
            before[third[inside]] = at[inside]
            has = first >= base
            shift = roots + width - base
            tree[shift + second] = _NONE
            r = self._rank(ids[at], ids[np.where(inside, third, at)])
            tree[shift + at] = np.where(inside & (r >= 0), r * width + at - base, _NONE)
            lower = first[has]
            r = self._rank(ids[lower], ids[at[has]])
            tree[(shift + first)[has]] = np.where(r >= 0, r * width + lower - base[has], _NONE)
            node = np.concatenate([at - base, second - base, np.where(has, first, at) - base])
            node += width
            lines = np.concatenate([roots, roots, roots])
            level = width
            while level > 1:
                node >>= 1
                child = lines + 2 * node
                tree[lines + node] = np.minimum(tree[child], tree[child + 1])
                level //= 2
            roots = roots[tree[roots + 1] < _NONE]
        flat = ids[live].astype("<i4").tobytes()
        stops = np.cumsum(live.reshape(m, width).sum(axis=1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def merge_one(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        none = 1 << 62
        ids: list[int] = self.single[np.frombuffer(piece, np.uint8)].tolist()
        tree = [none] * (2 * width)
        start = np.array(ids, np.int64)
        for k, r in enumerate(self._rank(start[:-1], start[1:]).tolist()):
            if r >= 0:
                tree[width + k] = r * width + k
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live = bytearray(b"\1") * n

        def put(leaf: int, value: int) -> None:
            node = width + leaf
            tree[node] = value
            node //= 2
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                value = a if a < b else b
                if tree[node] == value:
                    break
                tree[node] = value
                node //= 2

        while (best := tree[1]) < none:
            at = best % width
            ids[at] = best // width
            second = after[at]
            third = after[second]
            live[second] = 0
            after[at] = third
            put(second, none)
            r = -1
            if third < n:
                before[third] = at
                r = self._one(ids[at], ids[third])
            put(at, none if r < 0 else r * width + at)
            first = before[at]
            if first >= 0:
                r = self._one(ids[first], ids[at])
                put(first, none if r < 0 else r * width + first)
        return np.array([i for i, on in zip(ids, live, strict=True) if on], "<i4")

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, as little-endian 32-bit numbers; a token is its own id."""
        raw = [p.encode("utf-8", "replace") for p in pieces]
        found = list(map(self.ranks.get, raw))
        out = [b"" if r is None else r.to_bytes(4, "little") for r in found]
        classes: dict[int, list[int]] = {}
        for k in [k for k, r in enumerate(found) if r is None]:
            if len(raw[k]) > SHORT:
                out[k] = self.merge_one(raw[k]).tobytes()
            else:
                classes.setdefault(_WIDTH[len(raw[k])], []).append(k)
        for width, members in classes.items():
            step = max(1, LOCKSTEP // (2 * width))
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                for k, x in zip(part, self.merge_many([raw[k] for k in part], width),
                                strict=True):
                    out[k] = x
        return out

    def learn(self, units: set[str]) -> set[str]:
        """Make the ids of units known: each a blank and the unit.

        They are split together, as a text of them would be. Units that end in a blank, where a
        piece may continue, and empty ones are returned instead.
        """
        if self.new.size > REMEMBERED_BYTES:
            self.old, self.new = self.new, Remembered()
        units = units.difference(self.new)
        again = list(units.intersection(self.old))
        self.new.learn(again, list(map(self.old.__getitem__, again)))
        units.difference_update(again)
        odd = {u for u in units if not u or u[-1].isspace()}
        missing = list(units - odd) if odd else list(units)
        if missing:
            split = self.pattern.findall(" " + " ".join(missing))
            ids = self.pieces_of(split)
            ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
            stops = np.cumsum(np.fromiter(map(len, missing), np.int64, len(missing)) + 1)
            cuts = (np.searchsorted(ends, stops) + 1).tolist()
            values = [ids[a] if b - a == 1 else b"".join(ids[a:b])
                      for a, b in zip([0, *cuts], cuts, strict=False)]
            self.new.learn(missing, values)
        return odd

    def forget(self) -> None:
        """Give back what is remembered, so that idle workers are small."""
        self.new, self.old, self.pieces = Remembered(), Remembered(), Remembered()

    def pieces_of(self, parts: list[str]) -> list[bytes]:
        if self.pieces.size > REMEMBERED_BYTES:
            self.pieces = Remembered()
        unknown = list(set(parts).difference(self.pieces))
        self.pieces.learn(unknown, self.encode_pieces(unknown))
        return list(map(self.pieces.__getitem__, parts))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is empty.

        A text is cut at its blanks and the part before the first is split by itself. Where a
        part is empty or ends in a blank, a piece may cross the cut, and the text is split as
        a whole.
        """
        cut = [text.split(" ") if text else [""] for text in texts]
        heads = [units.pop(0) for units in cut]
        odd = self.learn(set().union(*cut))
        whole = {k for k, units in enumerate(cut) if heads[k][-1:].isspace()
                 or odd and not odd.isdisjoint(units) or not heads[k] and units}
        alone = [self.pattern.findall(texts[k] if k in whole else heads[k])
                 for k in range(len(texts))]
        ids = self.pieces_of([p for parts in alone for p in parts])
        get = self.new.__getitem__
        out, at = [], 0
        for k, (parts, units) in enumerate(zip(alone, cut, strict=True)):
            head = b"".join(ids[at : at + len(parts)])
            at += len(parts)
            rest = b"" if k in whole else b"".join(map(get, units))
            out.append(np.frombuffer(head + rest, "<i4"))
        return out


    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; one that is no token raises."""
        if not len(ids):
            return b""
        if ids.min() < 0:
            raise IndexError("an id below 0")
        size = self.sizes[ids]
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.starts[ids] - ends + size, size)
                         + np.arange(ends[-1])].tobytes()


_workers: dict[tuple, Bpe] = {}


def _worker(shared, pattern: str) -> Bpe:
    """The one encoder of a worker process, whatever number of tasks it runs."""
    key = (shared.value[0], pattern)
    if key not in _workers:
        _workers.clear()
        _workers[key] = Bpe(shared.value[0], pattern, shared.value[1:])
    return _workers[key]


def _share(tokens: tuple[bytes, ...], spark):
    return spark.sparkContext.broadcast((tokens, *merges_of(tokens)))


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    stops = np.cumsum([0, *map(len, found)])
    flat = np.concatenate(found) if found else np.zeros(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(flat, pa.int32()))


def encode(text: Column, tokens: tuple[bytes, ...], pattern: str, spark) -> Column:
    """Ids (array<int>) of a text column: each match of pattern by itself, no special tokens.

    A match that is a token is its id; else its bytes are merged pair by pair, least rank
    first, leftmost among equals. Null and empty texts have no ids. The tokens (read_ranks)
    and the arrays of their pairs are sent to the tasks, so their file need not be on every
    machine. Each task remembers units of bounded bytes and forgets them at its end.
    """
    shared = _share(tokens, spark)

    @F.arrow_udf("array<int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _worker(shared, pattern)
        for batch in texts:
            yield _lists([ids for part in chunks(batch.to_pylist()) for ids in bpe.encode(part)])
        bpe.forget()
        release()

    return run.asNondeterministic()(text)


def encode_and_back(text: Column, tokens: tuple[bytes, ...], pattern: str, spark) -> Column:
    """Struct of ids (see encode) and back, the bytes that decoding these ids gives; in one pass."""
    shared = _share(tokens, spark)

    @F.arrow_udf("ids array<int>, back binary")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _worker(shared, pattern)
        for batch in texts:
            found = [ids for part in chunks(batch.to_pylist()) for ids in bpe.encode(part)]
            back = pa.array([bpe.decode(ids) for ids in found], pa.binary())
            yield pa.StructArray.from_arrays([_lists(found), back], ["ids", "back"])
        bpe.forget()
        release()

    return run.asNondeterministic()(text)


def decode(ids: Column, tokens: tuple[bytes, ...], spark) -> Column:
    """Bytes (binary) of an array of ids; null and empty arrays have none.

    An id that is no token fails the query.
    """
    shared = _share(tokens, spark)

    @F.arrow_udf("binary")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _worker(shared, "")
        for batch in arrays:
            yield pa.array([b"" if x.values is None else bpe.decode(x.values.to_numpy())
                            for x in batch], pa.binary())
        release()

    return run.asNondeterministic()(ids)
