"""Small helpers shared by the corpus operators: word hashes, Arrow row batches, stage files."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from scoreloom.session import materialize

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z lower-cased, and every byte that ends an alphanumeric word turned into a space.
ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)
_ODD = np.random.RandomState(20).randint(1, 2**62, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table that is read more than once to the shared folder, compressed, and scan it from there."""
    return materialize(df, f"llm-{label}")


class WordHash(dict):
    """64-bit hash of a word, remembered for up to ``limit`` words (some 200 bytes each)."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, from the words' hashes (empty if there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * _ODD[j % 64]
    return mix(total)


def by_bytes(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs whose sizes add up to at most ``limit`` (one larger item is its own run)."""
    start, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if i >= start:
        yield start, i + 1


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and what it keeps adds up over the stages of a job."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """An Arrow function that gives its memory back when its task ends."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def text_slices(batch: pa.RecordBatch, column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with up to ``limit`` bytes of text (one longer text is its own), and their texts."""
    for a, b in by_bytes(pc.binary_length(column).fill_null(0).to_pylist(), limit):
        yield batch.slice(a, b - a), raw_texts(column.slice(a, b - a))


def sliced(
    batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array]
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """``text_slices`` of all batches, ``text`` naming the column."""
    for batch in batches:
        yield from text_slices(batch, text(batch))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
