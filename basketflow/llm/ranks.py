"""Places in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.session import stored


def ids_are_keys(rows: DataFrame, column: str = "doc_id") -> bool:
    """Whether no row lacks its id and no two share one."""
    times = rows.groupBy(F.col(column).alias("id")).agg(F.count("*").alias("times"))
    return times.filter("times > 1 OR id IS NULL").isEmpty()


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """`rows`, which must be stored, with a number of their own that ascends
    with doc_id, rows without id last, and then with a hash of the text. The
    numbers have gaps. Only rows equal in both are told apart by where they
    lie, so that a great many of them still fall into several ranges."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("_tie")]
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order)
    return stored(sorted_rows.drop("_tie").withColumn(name, F.monotonically_increasing_id()), "numbered")


def ranked(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """`rows`, which must be stored, with their 1-based place by `order`.

    Rows are dealt by ranges and placed within their range, then moved on by
    the rows of the ranges before; there are as many ranges as shuffle
    partitions. Where a row lies in its files decides between rows that are
    equal in `order`, so many equal ones fall into several ranges.
    """
    order = (*order, F.col("_tie").asc())
    ranges = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = stored(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = dealt.withColumn("_place", place).join(starts, "_range")
    return placed.select(*rows.columns, (F.col("_start") + F.col("_place")).alias(name))
