"""The latest model artifact of a listing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.sources import files

PREFIX = "output/"
SUFFIX = "/output/model.tar.gz"


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(key, last_modified) of the files below a folder, keys as full paths."""
    found = [(path, datetime.fromtimestamp(millis / 1000, timezone.utc)) for path, millis in files.listing(spark, folder)]
    return spark.createDataFrame(found, "key string, last_modified timestamp")


def latest(listing: DataFrame, prefix: str = PREFIX, suffix: str = SUFFIX) -> DataFrame:
    """The newest artifact, the lower key of two equally new ones: one row
    (key, last_modified), or none. Each task forwards only its own newest."""
    models = listing.filter(F.col("key").startswith(prefix) & F.col("key").endswith(suffix))
    newest_first = models.select("key", "last_modified").orderBy(F.desc("last_modified"), "key")
    return newest_first.limit(1)


def latest_key(listing: DataFrame, prefix: str = PREFIX, suffix: str = SUFFIX) -> str:
    row = latest(listing, prefix, suffix).first()
    if row is None:
        raise LookupError(f"no artifact ending in {suffix} below {prefix}")
    return row["key"]
