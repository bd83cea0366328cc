"""The prediction table: one row per user and product, in buckets of users.

A bucket is a folder. A batch of new scores reads and rewrites the buckets of
its users and leaves all others as they lie; a lookup of one user reads one.
How many buckets there are is kept beside the table, and dealing it anew writes
another folder before the record moves to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators import serve
from basketflow.session import scratch, scratch_scope
from basketflow.sources import files, versions
from basketflow.sources.zones import Zones

# A bucket is made for so many bytes of the first batch, within these numbers.
BUCKET_BYTES, LEAST, MOST = 256 << 20, 16, 20_000
BUCKET = "bucket"


def _bucket(user_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_id.cast("string")), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, zones: Zones) -> tuple[int, dict | None]:
    return versions.newest(spark, f"{zones.predictions()}/_layout")


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    """Rows into their buckets, each in order of user and product. A bucket
    with very many rows is several tasks, and one with few shares a task."""
    dealt = rows.withColumn(BUCKET, _bucket(F.col("user_id"), buckets)).hint("rebalance", BUCKET)
    write = dealt.sortWithinPartitions(BUCKET, *serve.KEY).write.mode("overwrite").partitionBy(BUCKET)
    write.option("partitionOverwriteMode", "dynamic").parquet(path)


def _use(spark: SparkSession, zones: Zones, number: int, buckets: int, rows: DataFrame) -> None:
    folder = uuid.uuid4().hex
    _write(rows, f"{zones.predictions()}/{folder}", buckets)
    versions.commit(spark, f"{zones.predictions()}/_layout", number, {"folder": folder, "buckets": buckets})


def read(spark: SparkSession, zones: Zones, user_id: str | None = None) -> DataFrame:
    """The table, or the rows of one user, for which one bucket is read."""
    _, layout = _layout(spark, zones)
    if layout is None:
        raise FileNotFoundError(f"no predictions at {zones.predictions()}")
    rows = spark.read.parquet(f"{zones.predictions()}/{layout['folder']}")
    if user_id is not None:
        mine = spark.range(1).select(_bucket(F.lit(user_id), layout["buckets"])).first()[0]
        rows = rows.filter((F.col(BUCKET) == mine) & (F.col("user_id") == user_id))
    return rows.drop(BUCKET)


def upsert(spark: SparkSession, zones: Zones, batch: DataFrame, version: str | None = None) -> list[int]:
    """Add the scores of `batch`, or put them in the place of those with their
    key; returns the buckets written. Within a batch the latest by `version`
    counts, then the highest score. A batch that is repeated changes nothing."""
    number, layout = _layout(spark, zones)
    with scratch_scope(spark):
        path = scratch(spark, "scored")
        serve.newest(batch, version).write.parquet(path)
        fresh = spark.read.parquet(path)
        if layout is None:
            buckets = min(MOST, max(LEAST, files.summary(spark, path)[1] // BUCKET_BYTES))
            _use(spark, zones, 0, buckets, fresh)
            return list(range(buckets))
        buckets, root = layout["buckets"], f"{zones.predictions()}/{layout['folder']}"
        by_user = _bucket(F.col("user_id"), buckets)
        touched = sorted(row[0] for row in fresh.select(by_user).distinct().collect())
        old = spark.read.parquet(root).filter(F.col(BUCKET).isin(touched))
        merged = serve.untouched(old, fresh).unionByName(fresh)
        if touched:
            _write(merged, root, buckets)
    return touched


def deal_anew(spark: SparkSession, zones: Zones, buckets: int) -> None:
    """The same rows in another number of buckets, for a table that has grown."""
    number, layout = _layout(spark, zones)
    _use(spark, zones, number + 1, buckets, read(spark, zones))
    files.delete(spark, f"{zones.predictions()}/{layout['folder']}")
