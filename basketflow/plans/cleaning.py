"""Raw zone to clean zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from basketflow import schemas
from basketflow.operators import orphans, validate
from basketflow.session import scratch, scratch_scope, sized_shuffles, stored, tune
from basketflow.sources import buckets, files, readers, writers
from basketflow.sources.zones import Zones


def load_table(
    raw: DataFrame, zones: Zones, table: str, load: int = 0, replace: bool = True, strict: bool = False
) -> dict[str, int]:
    """Write one load of a table; returns rows kept, and rows per broken rule.

    The raw files are parsed once: tagged rows are staged, kept ones as typed
    columns and rejected ones as text, in a folder each, and both tables are
    written from there. The rows are counted on the way.
    """
    spark = raw.sparkSession
    with scratch_scope(spark):
        seen = Observation(f"clean_{table}")
        staged = validate.staged(table, validate.tag(table, raw, strict, seen))
        path = scratch(spark, f"tagged-{table}")
        staged.write.partitionBy("rejected").parquet(path)
        rows = spark.read.schema(staged.schema).parquet(path)
        counts = {name: n for name, n in seen.get.items() if n or name == "kept"}
        writers.write_clean(validate.staged_kept(table, rows), zones, table, load, replace)
        bad = validate.staged_rejects(table, rows)
        if len(counts) > 1:
            writers.write_rejects(bad, zones, table, load, replace)
        elif replace:
            writers.write_rejects(bad.limit(0), zones, table, load, replace)
    return counts


def load_files(
    spark: SparkSession, zones: Zones, table: str, loads: dict[str, int], anew: bool = False, strict: bool = False
) -> None:
    """Clean raw files, each into the load given for it, in the place of what
    that load held. Other loads are left as they lie, or dropped if `anew`.

    All files are read in one job. A row finds its load by the file it is from,
    and is staged as in `load_table`. The list of files is stored, so that Spark
    knows how small it is and leaves the rows where they are.
    """
    carry = ("load",)
    found = [(files.uri(spark, path), load) for path, load in loads.items()]
    with scratch_scope(spark):
        by_file = stored(spark.createDataFrame(found, "_file string, load bigint").coalesce(1), "files")
        raw = readers.read_files(spark, table, list(loads)).join(by_file, "_file")
        staged = validate.staged(table, validate.tag(table, raw, strict, carry=carry), carry)
        path = scratch(spark, f"tagged-{table}")
        staged.write.partitionBy("rejected").parquet(path)
        rows = spark.read.schema(staged.schema).parquet(path)
        good, bad = (make(table, rows, carry) for make in (validate.staged_kept, validate.staged_rejects))
        buckets.forget(spark, zones, table)
        writers.replace_loads(good, zones.clean_table(table), loads.values(), anew)
        writers.replace_loads(bad.drop("table"), zones.rejects(table), loads.values(), anew, ["rule"])


def empty_table(spark: SparkSession, zones: Zones, table: str) -> None:
    """A clean table, and its rejects, without rows."""
    raw = spark.createDataFrame([], schemas.text_schema(table))
    good, bad = validate.clean(table, raw)
    writers.write_clean(good, zones, table)
    writers.write_rejects(bad, zones, table)


def report_orphans(spark: SparkSession, zones: Zones) -> None:
    """Write child rows without parent, from the clean tables as written."""
    tables = {table: readers.read_clean(spark, zones, table) for table in schemas.DECLARED}
    for name, frame in orphans.all_orphans(tables).items():
        writers.write_orphans(frame, zones, name)


def quality_report(spark: SparkSession, zones: Zones) -> DataFrame:
    """Counts over the quarantine, which holds bad rows only."""
    rejected = {}
    for table in schemas.DECLARED:
        rows = readers.read_rejects(spark, zones, table)
        rejected[table] = rows.selectExpr(f"'{table}' AS table", "rule")
    orphaned = {
        reference.name: spark.read.parquet(zones.orphans(reference.name))
        for reference in schemas.REFERENCES
    }
    return validate.quality_report(rejected, orphaned)


def clean_all(spark: SparkSession, zones: Zones, strict: bool = False) -> dict[str, dict[str, int]]:
    tune(spark)
    with sized_shuffles(spark, *(zones.raw_table(table) for table in schemas.DECLARED)):
        counts = {
            table: load_table(readers.read_raw(spark, zones, table), zones, table, strict=strict)
            for table in schemas.DECLARED
        }
        report_orphans(spark, zones)
    return counts
