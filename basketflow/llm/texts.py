"""Texts of an Arrow batch as NumPy arrays: bytes, words, and rolling hashes.

Everything works on slices of a few megabytes of text, so a task's memory does
not depend on how many or how long its documents are (one document is the
least a slice can hold).
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from basketflow.session import tune

SLICE_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_BASE = np.uint64(0xD6E8FEB86659FD93)
_WORD_BASE = np.uint64(0xA0761D6478BD642F)

# Words are runs of bytes outside space and 0x09-0x0D.
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a Python worker holds one at a time, next to the
    executor's own memory."""
    tune(spark)
    # Where workers share the driver's disk they find this package there; on a
    # cluster it comes with --py-files or is installed.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


# Files of a table for each partition of the shuffles that follow.
FILES_PER_TASK = 16 << 20
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of `sf_dir`, in a session whose shuffles begin with partitions
    enough for its files; Spark merges those that turn out small. Their number
    is only raised, as a result may run after another table is read."""
    frame = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    size = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = -(-size // FILES_PER_TASK)
    if wanted > int(spark.conf.get(PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(PARTITIONS, str(wanted))
    return frame


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits (one to one)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        row = np.full(max(n, 1 << 16) + n // 4, base, np.uint64)
        row[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(row)
    return have[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class Rolling:
    """Hashes of any stretch values[start:end] in constant time each."""

    def __init__(self, values: np.ndarray, base: np.uint64):
        n = len(values)
        self.back = powers(inverse(base), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64) * _ODD)


class Texts:
    """Some whole texts: their bytes one after another, and where each starts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self, lower: bool = False) -> "Words":
        return Words(self, lower)


class Words:
    """Words of some texts: `hashes` in order; document i owns
    hashes[bounds[i]:bounds[i + 1]]; word j is bytes start[j]:end[j]."""

    def __init__(self, texts: Texts, lower: bool):
        data = _LOWER[texts.data] if lower else texts.data
        inside = ~_BREAK[data]
        first = np.zeros(len(data) + 1, bool)  # a document begins here
        first[texts.offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, texts.offsets)
        self.hashes = Rolling(data, _BYTE_BASE).hash(self.start, self.end)
        self.data = data

    def __len__(self) -> int:
        return len(self.hashes)

    def word(self, j: int) -> bytes:
        return self.data[self.start[j] : self.end[j]].tobytes()

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def rolling(self) -> Rolling:
        return Rolling(self.hashes, _WORD_BASE)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of `size` words in one document."""
        last = self.bounds[1:][self.documents()] if len(self) else np.zeros(0, np.int64)
        at = np.flatnonzero(np.arange(len(self)) + size <= last)
        return at, self.rolling().hash(at, at + size)


def as_texts(column: pa.Array) -> Texts:
    """A string column without copying its bytes; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of the batches with at most `limit` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths.astype(np.int64)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, end - start)
            yield part, as_texts(part.column(column))
            start = end


def ids(column: pa.Array, missing: int = -(1 << 63)) -> np.ndarray:
    """An id column; null counts as the smallest id."""
    return pc.fill_null(column.cast(pa.int64()), missing).to_numpy(zero_copy_only=False)


MISSING_ID = -(1 << 63)
