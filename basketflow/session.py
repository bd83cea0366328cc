"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from basketflow.sources import files

T = TypeVar("T")

# Runtime SQL settings. Joins are never hinted: Spark broadcasts a side only
# when its size is under spark.sql.autoBroadcastJoinThreshold, and splits hot
# keys of shuffled joins at run time. Forcing the split lets it happen even
# where it costs one more shuffle, which is only paid when a key is hot.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A small side that is too large to broadcast sends a filter of its keys,
    # of 8 MB at most, into the scan of a large one before that is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    # Spark's own bound is 10 GB of files, some twenty times that in rows.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64m",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "basketflow", shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return tune(builder.getOrCreate())


# Bytes of files for a task. Numbers lie in Parquet at a twentieth of what rows
# take when they are sorted and grouped.
INPUT_PER_TASK = 16 << 20
PARTITIONS = "spark.sql.shuffle.partitions"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# What Spark may put into one task: of files, and of small partitions merged.
MERGED = 16 << 20
MOST_PER_TASK = {
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
}
# With tasks of such sizes, a side none of whose partitions is larger than the
# first of these is joined by hash: neither side is sorted. Its table can't be
# spilled and takes many times these bytes; below the size of merged partitions
# Spark takes no such bound. What is stored on the way is a third smaller than
# by the default codec.
SIZED = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(MERGED),
    "spark.sql.parquet.compression.codec": "zstd",
}


def files_size(frame: DataFrame) -> int:
    """Bytes of a frame's files, which Spark knows from listing them."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def size_tasks(spark: SparkSession, size: int) -> int:
    """From here on, tasks that stay as large however large the input: shuffles
    begin with partitions enough for `size` bytes of files, and neither a scan
    nor merged partitions give a task much more than its share. Partitions are
    only added and bounds only lowered, as a result may run after another is
    sized. Returns the number of partitions."""
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    wanted = max(int(spark.conf.get(PARTITIONS)), -(-size // INPUT_PER_TASK))
    spark.conf.set(PARTITIONS, str(wanted))
    if int(spark.conf.get(FIRST_PARTITIONS, None) or wanted) < wanted:
        spark.conf.set(FIRST_PARTITIONS, str(wanted))
    for key, default in MOST_PER_TASK.items():
        if as_bytes(spark.conf.get(key, None) or default) > MERGED:
            spark.conf.set(key, str(MERGED))
    for key, value in SIZED.items():
        spark.conf.set(key, value)
    return wanted


@contextmanager
def sized_shuffles(spark: SparkSession, *folders: str) -> Iterator[int]:
    """Within it, tasks are sized for the files of `folders`, see `size_tasks`.

    Adaptive execution merges partitions that turn out small, but cannot make
    more of them than there are. The size is the one Spark learns from listing
    the files, so nothing is read. The former settings come back afterwards.
    """
    before = {key: spark.conf.get(key, None) for key in (PARTITIONS, FIRST_PARTITIONS, *MOST_PER_TASK, *SIZED)}
    listed = spark.read.option("recursiveFileLookup", "true").text(list(folders))
    try:
        yield size_tasks(spark, files_size(listed))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_scratch: dict[str, list[str]] = {}
_once: dict[tuple, tuple[object, set[str]]] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder path that every executor can reach, until `release`.

    The parent is the session's checkpoint folder. Only a local master, where
    the one machine is the whole cluster, may fall back to a temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        parent = tempfile.mkdtemp(prefix="basketflow-")
    path = f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch folders of this application, or those made after the
    first `since`. Frames that read them end with that, and what `once` made
    of them is made again when asked for."""
    made = _scratch.get(spark.sparkContext.applicationId, [])
    gone = set(made[since:])
    for path in made[since:]:
        files.delete(spark, path)
    del made[since:]
    for key in [key for key, (_, paths) in _once.items() if gone & paths]:
        del _once[key]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what scratch folders were made within it."""
    since = len(_scratch.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, since)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: what follows starts
    from the files, however often it is used and whichever executors are lost."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, key: tuple, make: Callable[[], T]) -> T:
    """What `make` returns, made once per application and `key`, for as long
    as the scratch folders it made are there."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _once:
        before = len(_scratch.get(spark.sparkContext.applicationId, []))
        value = make()
        _once[key] = value, set(_scratch.get(spark.sparkContext.applicationId, [])[before:])
    return _once[key][0]
