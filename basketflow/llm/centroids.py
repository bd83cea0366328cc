"""Centroid clustering with bounds kept in heaps; exact, in whole numbers.

A vector is at most `upper` from its centroid and at least `lower` from all
others. When centroids move, the gap lower - upper shrinks by the drift of its
own centroid and the largest drift of the others at most. So each cluster adds
up these drifts, and a vector enters its cluster's heap under its gap plus what
had been added up by then: it keeps its place while that exceeds the sum. A
round pops the vectors whose gap has expired, compares them with all centroids
exactly, and pushes them into the heap of the nearest. All others are not
looked at, and a centroid's sums change only by vectors that change cluster.

Vectors lie in blocks of a thousand, each with a heap per cluster. The blocks
are written once, and the heaps once a round (8 bytes a vector), both as
tables bucketed by block, so they meet in every round without an exchange. The
driver holds the centroids and sums of theirs: numbers by clusters times width.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.topk import usable
from basketflow.session import scratch, stored
from basketflow.sources import files

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 8, 10, 64, 1024, 3
# A heap entry is a key and, in the last bits, the vector's row in its block.
ROW_BITS = 10
BLOCK = 1 << ROW_BITS
BLOCKS_PER_BUCKET, MOST_BUCKETS = 16, 50_000
# Bounds and drifts are whole 1024ths of a unit, always on the safe side.
FINE_BITS = 10
# Components are below this, so that squared distances fit 62 bits.
LIMIT = 1 << 27

BLOCKS = "block bigint, ids array<bigint>, vectors binary"
STATE = "block bigint, heaps binary, sizes array<int>, moved array<bigint>"


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of vectors of `width` components,
    none null or not finite. A component too large to be squared is an error."""
    fits = (F.size("embedding") == width) & usable(F.col("embedding"))

    def whole(x: Column) -> Column:
        scaled = F.floor(F.lit(scale) * x.cast("double"))
        refuse = F.raise_error(F.lit(f"vector component of {LIMIT} or more once scaled")).cast("bigint")
        return F.when(F.abs(F.lit(scale) * x.cast("double")) < LIMIT - 1, scaled).otherwise(refuse).cast("int")

    kept = vectors.filter(F.coalesce(fits, F.lit(False)))
    return kept.select(F.col("vec_id").cast("bigint"), F.transform("embedding", whole).alias("weights"))


def first_centroids(vectors: DataFrame, k: int, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes, all if there are fewer."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(key, 256).alias("hash"), "weights").orderBy("hash", "weights").limit(k)
    return [row["weights"] for row in first.collect()]


def _lists(column: pa.Array) -> list[np.ndarray]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def in_blocks(vectors: DataFrame, width: int) -> DataFrame:
    """Rows of up to BLOCK vectors each, filled as they are read."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = pa.concat_tables([waiting, table]) if waiting is not None else table
            while waiting.num_rows >= BLOCK:
                yield block(number, waiting.slice(0, BLOCK))
                number, waiting = number + 1, waiting.slice(BLOCK)
        if waiting is not None and waiting.num_rows:
            yield block(number, waiting)

    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        ids = pa.array([rows.column("vec_id").to_pylist()], pa.list_(pa.int64()))
        flat = rows.column("weights").combine_chunks().flatten().to_numpy().astype("<i4")
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), ids, pa.array([flat.tobytes()], pa.binary())], names=["block", "ids", "vectors"]
        )

    return vectors.mapInArrow(fill, BLOCKS)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to each centroid."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        apart = vectors - centroid
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def gaps(squared: np.ndarray, own: np.ndarray) -> np.ndarray:
    """lower - upper of each row of squared distances, in fine units."""
    at = np.arange(len(squared))
    upper = np.floor(np.sqrt(squared[at, own].astype(float)) * (1 << FINE_BITS)).astype(np.int64) + 2
    if squared.shape[1] == 1:
        return np.full(len(squared), 1 << 50, np.int64)
    others = squared.copy()
    others[at, own] = np.iinfo(np.int64).max
    lower = np.floor(np.sqrt(others.min(axis=1).astype(float)) * (1 << FINE_BITS)).astype(np.int64) - 2
    return lower - upper


def turn(
    vectors: np.ndarray, heaps: list[np.ndarray] | None, centroids: np.ndarray, drifted: list[int]
) -> tuple[list[np.ndarray], np.ndarray, int]:
    """One round of a block: the new heaps, what moved, and how many vectors
    were rescanned. Without heaps, all vectors are.

    `moved` is per cluster a count and the sum of the vectors that came, less
    those that left."""
    k, width = centroids.shape
    mask = BLOCK - 1
    lists: dict[int, list[int]] = {}
    rows, was = [], []
    if heaps is None:
        heaps = [np.zeros(0, np.int64)] * k
        rows, was = list(range(len(vectors))), [-1] * len(vectors)
    else:
        for j, heap in enumerate(heaps):
            if len(heap) and heap[0] >> ROW_BITS <= drifted[j]:
                entries = lists[j] = heap.tolist()
                while entries and entries[0] >> ROW_BITS <= drifted[j]:
                    rows.append(heapq.heappop(entries) & mask)
                    was.append(j)
    moved = np.zeros((k, 1 + width), np.int64)
    if rows:
        at, old = np.array(rows), np.array(was)
        squared = distances(vectors[at], centroids)
        own = squared.argmin(axis=1)
        keys = (gaps(squared, own) + np.array(drifted, np.int64)[own] << ROW_BITS) | at
        for j in range(k):
            mine = keys[own == j].tolist()
            if mine:
                entries = lists.setdefault(j, heaps[j].tolist())
                if len(mine) < len(entries):
                    for key in mine:
                        heapq.heappush(entries, key)
                else:
                    entries.extend(mine)
                    heapq.heapify(entries)
            for sign, side in ((1, (own == j) & (old != j)), (-1, (old == j) & (own != j))):
                moved[j, 0] += sign * side.sum()
                moved[j, 1:] += sign * vectors[at[side]].sum(axis=0)
    new = [np.array(lists[j], np.int64) if j in lists else heap for j, heap in enumerate(heaps)]
    return new, moved, len(rows)


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray] | None]]:
    """(row of the batch, vectors, heaps) of each block of a batch."""
    has_state = "heaps" in batch.schema.names
    sizes = _lists(batch.column("sizes")) if has_state else None
    for i, packed in enumerate(batch.column("vectors")):
        vectors = np.frombuffer(packed.as_buffer(), "<i4").reshape(-1, width).astype(np.int64)
        heaps = None
        if has_state:
            flat = np.frombuffer(batch.column("heaps")[i].as_buffer(), "<i8")
            heaps = np.split(flat, np.cumsum(sizes[i])[:-1])
        yield i, vectors, heaps


def next_state(rows: DataFrame, centroids: list[list[int]], drifted: list[int]) -> DataFrame:
    """The heaps of each block after one round, and what moved."""
    fixed, width = np.array(centroids, np.int64), len(centroids[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heaps, sizes, moves = [], [], []
            for _, vectors, before in _unpacked(batch, width):
                new, moved, _ = turn(vectors, before, fixed, drifted)
                heaps.append(np.concatenate(new).astype("<i8").tobytes())
                sizes.append([len(heap) for heap in new])
                moves.append(moved.ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("block"),
                    pa.array(heaps, pa.binary()),
                    pa.array(sizes, pa.list_(pa.int32())),
                    pa.array(moves, pa.list_(pa.int64())),
                ],
                names=["block", "heaps", "sizes", "moved"],
            )

    return rows.mapInArrow(work, STATE)


def last_assignment(rows: DataFrame, centroids: list[list[int]], drifted: list[int]) -> DataFrame:
    """(vec_id, cluster, distance) after one more round."""
    fixed, width = np.array(centroids, np.int64), len(centroids[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for i, vectors, before in _unpacked(batch, width):
                heaps, _, _ = turn(vectors, before, fixed, drifted)
                cluster = np.empty(len(vectors), np.int32)
                for j, heap in enumerate(heaps):
                    cluster[heap & (BLOCK - 1)] = j
                apart = vectors - fixed[cluster]
                squared = np.einsum("ij,ij->i", apart, apart)
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, pa.array(cluster), pa.array(squared)], names=["vec_id", "cluster", "distance"]
                )

    return rows.mapInArrow(work, "vec_id bigint, cluster int, distance bigint")


def bucketed(frame: DataFrame, label: str, buckets: int) -> tuple[str, str]:
    """`frame` as a table bucketed by block; its name and folder."""
    path = scratch(frame.sparkSession, label)
    name = f"{label}_{uuid.uuid4().hex}"
    frame.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return name, path


def _forget(spark: SparkSession, table: tuple[str, str] | None) -> None:
    if table:
        spark.sql(f"DROP TABLE {table[0]}")
        files.delete(spark, table[1])


def moved_sums(state: DataFrame, k: int, width: int) -> list[list[int]]:
    """What moved in all blocks: per cluster a count and a sum per component."""
    at = state.select(F.posexplode("moved").alias("at", "n"))
    total = at.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    flat = {row["at"]: int(row["n"]) for row in total}
    return [[flat.get(j * (1 + width) + i, 0) for i in range(1 + width)] for j in range(k)]


def drift(before: list[int], after: list[int]) -> int:
    """How far a centroid moved, rounded up to fine units."""
    squared = sum((a - b) ** 2 for a, b in zip(before, after))
    return math.isqrt(squared << 2 * FINE_BITS) + 1 if squared else 0


def cluster(
    embeddings: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    per vector. Each round assigns all vectors to the nearest centroid, ties to
    the smaller number, and moves every centroid that has any to the floor of
    its vectors' mean; then vectors are assigned once more.

    Vectors that are null, of other than `width` components, or with one null
    or not finite take no part. A null id is kept, and hashed as empty text.
    Rows that repeat are vectors each; of rows with one id the smaller vector
    starts first. With fewer vectors than `k` there are as many clusters. An
    empty table gives no rows. Components of 2 ** 27 or more once scaled are an
    error, as squares of theirs need not fit the result."""
    spark = embeddings.sparkSession
    vectors = quantised(embeddings, width, scale)
    centroids = first_centroids(vectors, k, seed)
    fields = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], fields)
    k = len(centroids)
    filled = stored(in_blocks(vectors, width), "filled-blocks")
    buckets = min(MOST_BUCKETS, -(-filled.count() // BLOCKS_PER_BUCKET))
    blocks = bucketed(filled.repartition(buckets, "block"), "blocks", buckets)
    state: tuple[str, str] | None = None

    def placed(*columns: str) -> DataFrame:
        """The blocks beside their heaps, which are the smaller side."""
        rows = spark.table(blocks[0]).select("block", *columns)
        if state is None:
            return rows
        heaps = spark.table(state[0]).select("block", "heaps", "sizes")
        return rows.join(heaps.hint("shuffle_hash"), "block")

    drifted, sums = [0] * k, [[0] * (1 + width) for _ in range(k)]
    for _ in range(rounds):
        after = bucketed(next_state(placed("vectors"), centroids, drifted), "heaps", buckets)
        _forget(spark, state)
        state = after
        moved = moved_sums(spark.table(state[0]), k, width)
        sums = [[a + b for a, b in zip(*pair)] for pair in zip(sums, moved)]
        moved_to = [[s // n[0] for s in n[1:]] if n[0] else centroid for n, centroid in zip(sums, centroids)]
        if moved_to == centroids:
            break  # so will all rounds be that follow
        steps = [drift(*pair) for pair in zip(centroids, moved_to)]
        for j in range(k):
            drifted[j] += steps[j] + max(steps[:j] + steps[j + 1 :], default=0)
        centroids = moved_to
    found = stored(last_assignment(placed("ids", "vectors"), centroids, drifted), "clusters")
    _forget(spark, state)
    _forget(spark, blocks)

    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    inertia = {row["cluster"]: int(row["sum"]) for row in per}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = F.col("cluster")
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        F.array(*(F.lit(inertia.get(j, 0)).cast("bigint") for j in range(k)))[at].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.array(*map(F.lit, digests))[at].alias("centroid_sha256"),
    )
