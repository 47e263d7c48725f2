"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

from strata.session import ship_package as ship  # noqa: F401

#: Odd multiplier of the polynomial substring hashes (arithmetic modulo 2**64).
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_TABLE = np.random.default_rng(20240601).integers(1, 2**63, 65536, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; ``sf_dir`` is any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as Spark takes it literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the entropy of 64-bit hashes over all bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, dtype=np.uint64)
            down = np.full(size, _INVERSE, dtype=np.uint64)
            up[0] = down[0] = 1
            _POWERS[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _POWERS[size]


class SubstringHash:
    """64-bit hashes of any substrings of a symbol array, from one prefix sum.

    ``symbols`` are small integers (bytes or code points); substring ``[a, b)``
    has the same hash wherever it stands.
    """

    def __init__(self, symbols: np.ndarray, values: np.ndarray | None = None):
        n = len(symbols)
        up, self._down = _powers(n)
        if values is None:
            values = _TABLE[symbols] if symbols.dtype == np.uint8 else mix64(symbols.astype(np.uint64) + _BASE)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values * up[:n], out=self._sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` symbols, by start."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return mix64((self._sums[width:] - self._sums[:n]) * self._down[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings ``[start, end)``."""
        with np.errstate(over="ignore"):
            length = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            return mix64((self._sums[end] - self._sums[start]) * self._down[start] + length)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    if len(x) < width:
        return x[:0]
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for each length, concatenated."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths, lengths)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", target: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into slices of about ``target`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // target
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
