"""Shuffles of many small numbers, sent as compressed columns.

A task sorts what it has by a 64-bit key, cuts the sorted rows at the borders
of equal key ranges ("buckets") and sends each piece as one row of compressed
arrays. Keys are hashes, so buckets are even; a caller first folds the repeats
of a key within its task, so that a key which holds a large part of all rows
reaches its bucket once per piece of input and not once per row.

A task deals into 4,096 ranges at most. Where the data need more buckets, a
second exchange deals each of these ranges into its buckets, from batches of
some million keys in which a key is folded again. So a piece is never a handful
of keys, and a hot key reaches its bucket once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

BUCKET_KEYS = 400_000
# Ranges that a task deals into, in bits, and the keys that a task of the
# second exchange takes at once: over 1,000 for each of the next 8,192 ranges.
LEVEL_BITS = 12
LEVEL_KEYS = 8 << 20
# Keys of one task of an exchange, some 50 MB of pieces.
TASK_KEYS = 5_000_000


def pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """Compress an integer array; `ordered` ones are kept as differences."""
    if ordered and len(values):
        values = np.concatenate([values[:1], values[1:] - values[:-1]])
    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T if len(values) else np.zeros((width, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, kind: type, ordered: bool = False) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    width = np.dtype(kind).itemsize
    values = np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if ordered else values


def bucket_bits(keys: int, per_bucket: int = BUCKET_KEYS) -> int:
    """Bits of the key that name its bucket, so that a bucket is about `per_bucket` keys."""
    return max(3, int(np.ceil(np.log2(max(1, keys / per_bucket)))))


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Ranges:
    """How about `keys` keys are dealt into buckets, in one step or two."""

    keys: int
    per_bucket: int = BUCKET_KEYS
    level: int = LEVEL_BITS
    at_once: int = LEVEL_KEYS

    @property
    def bits(self) -> int:
        return bucket_bits(self.keys, self.per_bucket)

    @property
    def deep(self) -> bool:
        return self.bits > self.level

    def fine(self, keys: np.ndarray) -> np.ndarray:
        """The bucket of each key."""
        return bucket_of(keys, self.bits)

    def first(self, keys: np.ndarray) -> np.ndarray:
        """The range a task deals each key into, named by its first bucket."""
        top = min(self.bits, self.level)
        return bucket_of(keys, top) << (self.bits - top)


COLUMNS = 5
SCHEMA = "bucket bigint, kind int, " + ", ".join(f"c{i} binary" for i in range(COLUMNS))
ARROW = pa.schema(
    [("bucket", pa.int64()), ("kind", pa.int32()), *((f"c{i}", pa.binary()) for i in range(COLUMNS))]
)


def pieces(
    buckets: np.ndarray, columns: Sequence[np.ndarray], kind: int = 0, ordered: bool = True
) -> Iterator[pa.RecordBatch]:
    """Rows for `buckets`, which are in ascending order; if `ordered`, the
    first column ascends within each bucket."""
    if not len(buckets):
        return
    cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    ends = np.append(cuts[1:], len(buckets))
    blobs: list[list[bytes | None]] = [[] for _ in range(COLUMNS)]
    for a, b in zip(cuts, ends):
        for i in range(COLUMNS):
            blobs[i].append(pack(columns[i][a:b], ordered and i == 0) if i < len(columns) else None)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(buckets[cuts]),
            pa.array(np.full(len(cuts), kind, np.int32)),
            *(pa.array(b, pa.binary()) for b in blobs),
        ],
        schema=ARROW,
    )


def gather(rows, kinds: Sequence[type], kind: int = 0, ordered: bool = True) -> list[np.ndarray]:
    """The columns of all rows of one kind in a pandas frame of pieces."""
    rows = rows[rows["kind"] == kind]
    out = []
    for i, dtype in enumerate(kinds):
        parts = [unpack(blob, dtype, ordered and i == 0) for blob in rows[f"c{i}"]]
        out.append(np.concatenate(parts) if parts else np.zeros(0, dtype))
    return out


def grouped(rows: DataFrame, ranges: Ranges) -> GroupedData:
    """Pieces by bucket, in tasks enough for their keys."""
    tasks = -(-ranges.keys // TASK_KEYS)
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(tasks, "bucket")
    return rows.groupBy("bucket")


def refined(
    rows: DataFrame,
    ranges: Ranges,
    kinds: Sequence[type],
    send: Callable[..., Iterator[pa.RecordBatch]],
    kind: int = 0,
) -> DataFrame:
    """Pieces of one kind, of the ranges of a first step, dealt anew: `send` gets
    the columns of some `at_once` keys, nearly all of one range, and yields
    pieces of buckets. A range that takes several tasks is split by a hash of
    its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            blobs = [batch.column(f"c{i}") for i in range(len(kinds))]
            for row in range(batch.num_rows):
                held.append([unpack(b[row].as_py(), t, i == 0) for i, (b, t) in enumerate(zip(blobs, kinds))])
                if sum(len(columns[0]) for columns in held) >= ranges.at_once:
                    yield from send(*(np.concatenate(c) for c in zip(*held)))
                    held = []
        if held:
            yield from send(*(np.concatenate(c) for c in zip(*held)))

    shares = -(-ranges.keys // (ranges.at_once << ranges.level))
    dealt = rows.filter(F.col("kind") == kind).repartition(
        shares << ranges.level,
        F.shiftright("bucket", ranges.bits - ranges.level),
        F.pmod(F.xxhash64("c0"), F.lit(shares)),
    )
    return dealt.sortWithinPartitions("bucket").mapInArrow(run, SCHEMA)


def text_bytes(documents: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts, by which buckets are numbered."""
    return documents.agg(F.sum(F.octet_length(column))).first()[0] or 0
