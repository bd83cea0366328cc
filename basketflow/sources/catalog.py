"""SQL access to what the jobs wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketflow import schemas
from basketflow.sources import files
from basketflow.sources.readers import read_clean, read_curated
from basketflow.sources.zones import Zones

CURATED = ["order_products_prior", "user_features", "up_features", "product_features", "ml_dataset"]


def register_frames(frames: dict[str, DataFrame]) -> list[str]:
    """Name frames for spark.sql; returns the names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)


def register(spark: SparkSession, zones: Zones) -> list[str]:
    """Views over the clean and curated tables."""
    frames = {table: read_clean(spark, zones, table) for table in schemas.DECLARED}
    frames.update({table: read_curated(spark, zones, table) for table in CURATED})
    return register_frames(frames)


def register_database(spark: SparkSession, zones: Zones, database: str) -> list[str]:
    """The curated tables as external tables of a catalog database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in CURATED:
        name = f"`{database}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{zones.curated_table(table)}'")
        parts = files.names(spark, zones.curated_table(table))
        if any("=" in part for part in parts):
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return CURATED


def analyze(spark: SparkSession, database: str) -> None:
    """Statistics of all columns, by which Spark then orders joins."""
    spark.conf.set("spark.sql.cbo.enabled", "true")
    spark.conf.set("spark.sql.cbo.joinReorder.enabled", "true")
    for table in spark.catalog.listTables(database):
        spark.sql(f"ANALYZE TABLE `{database}`.`{table.name}` COMPUTE STATISTICS FOR ALL COLUMNS")


def write_result(spark: SparkSession, zones: Zones, query: str, folder: str) -> None:
    """Run a query over the curated tables, by their names, and write what it
    returns to a folder, in the place of what is there. It runs in a session of
    its own with the same settings, where no view of the caller's stands in for
    a table of that name."""
    own, database = spark.newSession(), f"curated_{uuid.uuid4().hex}"
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    register_database(own, zones, database)
    try:
        analyze(own, database)
        own.catalog.setCurrentDatabase(database)
        target = folder.replace("\\", "\\\\").replace("'", "\\'")
        own.sql(f"INSERT OVERWRITE DIRECTORY '{target}' USING parquet {query}")
    finally:
        own.catalog.setCurrentDatabase("default")
        own.sql(f"DROP DATABASE `{database}` CASCADE")
