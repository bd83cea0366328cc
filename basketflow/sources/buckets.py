"""Clean tables bucketed by order, so that joins by order move neither side.

Such a table is the same folder of Parquet files, written by the hash of the
order with one file per bucket and load, and named in the session's catalog
when it is read. How many buckets it has is kept beside it. A table in which
one bucket holds far more than its share, as with one very busy order, is not
bucketed: Spark splits hot keys of a join only when it shuffles it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.sources import files, versions
from basketflow.sources.zones import Zones

KEY = "order_id"
TABLES = ["orders", "order_products"]
# A bucket may hold so many times the mean, or this many rows.
UNEVEN, FEW = 4, 1_000_000
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _record(zones: Zones, table: str) -> str:
    return f"{zones.clean}/_buckets/{table}"


def count(spark: SparkSession, zones: Zones, table: str) -> int | None:
    """How many buckets the table has; none if it has not."""
    _, record = versions.newest(spark, _record(zones, table))
    return record["buckets"] if record else None


def plan(rows: DataFrame) -> int | None:
    """Buckets for these stored rows: as many as a shuffle now has partitions."""
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(F.pmod(F.hash(KEY), F.lit(buckets))).agg(F.count("*").alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return buckets if (largest or 0) <= max(FEW, UNEVEN * (total or 0) / buckets) else None


def forget(spark: SparkSession, zones: Zones, table: str) -> None:
    """The table is about to be written without buckets."""
    files.delete(spark, _record(zones, table))


def name(spark: SparkSession, zones: Zones, table: str, buckets: int) -> str:
    """The table as the session's catalog names it, with the loads it has now."""
    named = f"clean_{hashlib.sha256(zones.clean.encode()).hexdigest()[:16]}_{table}"
    columns = ", ".join(f"{column} {kind}" for column, kind in schemas.declared(table))
    where = zones.clean_table(table).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {named}")
    spark.sql(
        f"CREATE TABLE {named} ({columns}, load BIGINT) USING parquet PARTITIONED BY (load) "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    if files.exists(spark, zones.clean_table(table)):
        spark.sql(f"MSCK REPAIR TABLE {named}")
    return named


def write(df: DataFrame, zones: Zones, table: str, load: int, replace: bool, buckets: int) -> None:
    """One load; `replace` drops all others. Until the number of buckets is
    noted, the table is read as the plain files it also is."""
    spark = df.sparkSession
    if replace:
        forget(spark, zones, table)
        files.delete(spark, zones.clean_table(table))
    dealt = df.withColumn("load", F.lit(load).cast("bigint")).repartition(buckets, KEY)
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        dealt.write.insertInto(name(spark, zones, table, buckets), overwrite=True)
    finally:
        spark.conf.set(OVERWRITE, before)
    if replace:
        versions.commit(spark, _record(zones, table), 0, {"buckets": buckets})


def read(spark: SparkSession, zones: Zones, table: str, buckets: int) -> DataFrame:
    return spark.table(name(spark, zones, table, buckets))
