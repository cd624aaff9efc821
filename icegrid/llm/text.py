"""Words, hashes and batches that several operators share. All run inside tasks, on numpy."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

from icegrid.session import tune

# Bytes other than 0-9, a-z (after lower-casing A-Z) and non-ASCII ones separate words.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
CHUNK_CHARS = 1 << 21
# Whole texts that Spark hands to a Python worker at once; results of a batch are held together.
BATCH_ROWS = 1000


def tune_texts(spark: SparkSession) -> SparkSession:
    """The library's settings, with batches that suit rows of long texts."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def alnum_words(text: str | None) -> list[bytes]:
    """Words of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; null has none."""
    return text.encode("utf-8", "replace").translate(ALNUM).split() if text else []


def blank_words(text: str | None) -> list[bytes]:
    """Words of [^\\x20\\x09-\\x0D]+ after lower-casing A-Z; null has none."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def chunks(texts: Iterable[str | None], limit: int = CHUNK_CHARS) -> Iterator[list[str | None]]:
    """Consecutive texts in lists of about limit characters, so that memory is bounded."""
    part: list[str | None] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text) if text else 0
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def release() -> None:
    """Give back what a finished task no longer needs, as workers stay alive beside each other."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of entries."""

    def __init__(self, entries: int = 200_000):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.entries:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
