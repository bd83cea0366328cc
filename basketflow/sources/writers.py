"""Parquet sinks. Every sink can be rerun: a retry replaces what it wrote."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.copies import repeat_rows
from basketflow.session import scratch_scope, stored
from basketflow.sources import buckets, files
from basketflow.sources.zones import Zones


def write_clean(df: DataFrame, zones: Zones, table: str, load: int = 0, replace: bool = True) -> None:
    """One load of a clean table; `replace` drops all earlier loads. The rows
    should be stored. Tables joined by order are bucketed by it, if the rows of
    the first load spread evenly."""
    spark = df.sparkSession
    if table in buckets.TABLES:
        number = buckets.plan(df) if replace else buckets.count(spark, zones, table)
        if number:
            buckets.write(df, zones, table, load, replace, number)
            return
        buckets.forget(spark, zones, table)
    _write_load(df, zones.clean_table(table), load, replace, [])


def write_rejects(df: DataFrame, zones: Zones, table: str, load: int = 0, replace: bool = True) -> None:
    """One load of a table's rejected rows, foldered by the rule they broke.
    They are few for their number of tasks, so they are gathered by rule first;
    a rule with very many is split again."""
    _write_load(df.drop("table").hint("rebalance", "rule"), zones.rejects(table), load, replace, ["rule"])


def _write_load(df: DataFrame, root: str, load: int, replace: bool, partitions: list[str]) -> None:
    if replace:
        writer = df.withColumn("load", F.lit(load).cast("bigint")).write.partitionBy("load", *partitions)
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(root)
    else:
        writer = df.write.partitionBy(*partitions) if partitions else df.write
        writer.mode("overwrite").parquet(f"{root}/load={load}")


def replace_loads(
    rows: DataFrame, root: str, loads: Collection[int], anew: bool = False, partitions: Sequence[str] = ()
) -> None:
    """Rows, which should be stored, by their `load`, in the place of what these
    loads held; `anew` drops all others. Other folders are not touched; of the
    loads given, one without rows, or without rows of some partition, keeps none."""
    spark, columns = rows.sparkSession, ["load", *partitions]
    there = rows.select(columns).distinct().collect()
    ordered = rows.hint("rebalance", *columns) if partitions else rows
    write = ordered.write.mode("overwrite").partitionBy(*columns)
    write.option("partitionOverwriteMode", "static" if anew else "dynamic").parquet(root)
    if anew:
        return
    full = {"/".join(f"{name}={row[name]}" for name in columns) for row in there}
    for load in loads:
        for part in files.names(spark, f"{root}/load={load}") if partitions else [""]:
            folder = f"load={load}/{part}".rstrip("/")
            if folder not in full:
                files.delete(spark, f"{root}/{folder}")


def write_curated(df: DataFrame, zones: Zones, table: str, sort_by: str | None = None) -> None:
    """A curated table. `sort_by` range-partitions, so that file after file is
    in global order without one task writing everything. The rows are stored
    before that: placing the borders of the ranges reads them once more."""
    path = zones.curated_table(table)
    if not sort_by:
        df.write.mode("overwrite").parquet(path)
        return
    with scratch_scope(df.sparkSession):
        ranged = stored(df, "to-sort").repartitionByRange(sort_by).sortWithinPartitions(sort_by)
        ranged.write.mode("overwrite").parquet(path)


def write_ml_split(compact: DataFrame, zones: Zones) -> None:
    """Both splits of the compact ML set in one job, foldered by eval_set."""
    splits = compact.filter(F.col("eval_set").isin("train", "test"))
    repeat_rows(splits).write.mode("overwrite").partitionBy("eval_set").parquet(zones.ml_dataset())


def write_orphans(df: DataFrame, zones: Zones, reference: str) -> None:
    df.write.mode("overwrite").parquet(zones.orphans(reference))
