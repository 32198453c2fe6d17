"""What the operators of this subpackage share: reading documents, folds, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK_BYTES = 2 << 20  # of text that a task works on at once
MASK = (1 << 64) - 1
# fixed values: the steps of a public 64-bit mixing function
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n. A row without an id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def raw(column: str = "text") -> Column:
    """A text as UTF-8 bytes; null as an empty text."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of the table has, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of them."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """The values with all bits stirred, so that their order is random."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= np.uint64(BASE)
        out += hashes[i : i + n]
    return mix(out)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels after members a and b were linked: the smallest position of a component."""
    while True:
        one, two = labels[a], labels[b]
        if np.array_equal(one, two):
            return labels
        least = np.minimum(one, two)
        np.minimum.at(labels, one, least)
        np.minimum.at(labels, two, least)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
