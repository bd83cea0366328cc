"""Scans of the raw and the Parquet zones."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.sources import buckets
from basketflow.sources.zones import Zones

# Quotes inside a quoted cell are doubled. Lines are records, so files split.
CSV = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
# A file whose header differs from the table's fails instead of being misread.
CHECKED = {**CSV, "enforceSchema": "false"}


def read_raw(spark: SparkSession, zones: Zones, table: str, **options: str) -> DataFrame:
    """The raw table as text, columns by header name; blank cells are null."""
    frame = spark.read.options(**CHECKED, **options).csv(zones.raw_table(table))
    return frame.select(schemas.columns(table))


def read_files(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """Some raw files of a table, each row with its file's URI as `_file`."""
    plain = [re.sub(r"([\\*?{}\[\]])", r"\\\1", path) for path in paths]
    frame = spark.read.options(**CHECKED).csv(plain)
    return frame.select(*schemas.columns(table), F.col("_metadata.file_path").alias("_file"))


def stream_raw(spark: SparkSession, zones: Zones, table: str, **options: str) -> DataFrame:
    """The raw table as a file stream, columns in declared order."""
    return (
        spark.readStream.schema(schemas.text_schema(table))
        .options(**CHECKED, **options)
        .csv(zones.raw_table(table))
    )


def read_clean(spark: SparkSession, zones: Zones, table: str, loads: list[int] | None = None) -> DataFrame:
    """The clean table with its declared columns, over all its loads or these."""
    schema = T.StructType(schemas.typed_schema(table).fields + [T.StructField("load", T.LongType())])
    number = buckets.count(spark, zones, table) if table in buckets.TABLES else None
    if number:
        rows = buckets.read(spark, zones, table, number)
    else:
        rows = spark.read.schema(schema).parquet(zones.clean_table(table))
    return (rows if loads is None else rows.filter(F.col("load").isin(loads))).drop("load")


def read_curated(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    """A curated table; history that came in loads has a folder for each."""
    return spark.read.parquet(zones.curated_table(table)).drop("part")


def read_ml_split(spark: SparkSession, zones: Zones, eval_set: str) -> DataFrame:
    """One split of the ML set; partition pruning skips the other."""
    ml_set = spark.read.parquet(zones.ml_dataset())
    return ml_set.filter(F.col("eval_set") == eval_set).select(schemas.ML_COLUMNS)


def read_rejects(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    fields = schemas.text_schema(table).fields
    schema = T.StructType(
        fields + [T.StructField("load", T.LongType()), T.StructField("rule", T.StringType())]
    )
    return spark.read.schema(schema).parquet(zones.rejects(table)).drop("load")
