"""Shared parts of the text operators: Arrow slices of bounded size, and tokens, token
hashes and window hashes of a whole slice at once (numpy on the UTF-8 bytes).

A word is a maximal run of bytes other than space and 0x09-0x0D (``[^\\x20\\x09-\\x0D]+``).
Null text counts as empty text. Functions here run inside Spark tasks on one slice of a
partition: their memory is bounded by ``SLICE_BYTES`` or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

_M = 0x9E3779B97F4A7C15 | 1
_M_INV = pow(_M, -1, 1 << 64)
_powers: list[np.ndarray] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def smallest_hashes(df: DataFrame, hash_col: str, most: int, *then: str) -> DataFrame:
    """The ``most`` rows with the smallest 64-bit hashes. The table is counted first and cut
    to about four times as many by hash, so a task sorts and sends a bounded share."""
    n = df.count()
    if n > 8 * most:
        df = df.filter(F.col(hash_col) < F.lit(-(1 << 63) + (1 << 64) * 4 * most // n))
    return df.orderBy(hash_col, *then).limit(most)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M**0..n-1 and their inverses modulo 2**64 (grown as needed, kept per worker)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, np.uint64(m)))])
                      for m in (_M, _M_INV)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """64-bit hashes of ``values[start:end]``: polynomial, by prefix sums, then mixed with
    the range's length."""

    def __init__(self, values: np.ndarray):
        p, self.inv = powers(len(values) + 1)
        self.c = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * p[: len(values)], out=self.c[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.c[ends] - self.c[starts]) * self.inv[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RangeHash(values)(starts, ends)


@dataclass
class Slice:
    """Rows ``first..`` of a batch: the UTF-8 bytes of their texts and each text's place."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]: self.offsets[i + 1]].tobytes()

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text: its first token; one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive rows with at most ``most`` bytes of text, or a single row."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_string()).fill_null("")
        n = len(texts)
        if n == 0:
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset:]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
            yield Slice(batch.slice(i, j - i), data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
            i = j


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes unchanged."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def tokens(data: np.ndarray, offsets: np.ndarray, gap: Callable[[np.ndarray], np.ndarray] = is_space) -> Tokens:
    """Words of all texts of a slice; a word never spans two texts."""
    word = ~gap(data)
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Tokens(starts, ends, np.searchsorted(starts, offsets))


def words_of(text: bytes) -> list[bytes]:
    """``bytes.split`` splits on exactly the six separators of a word."""
    return text.split()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
