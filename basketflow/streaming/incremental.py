"""Clean only raw files that no earlier run has seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketflow.plans.cleaning import load_table
from basketflow.session import tune
from basketflow.sources.readers import stream_raw
from basketflow.sources.zones import Zones


def incremental_clean(
    spark: SparkSession,
    zones: Zones,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Run until the raw table's present files are done, and stop.

    The checkpoint remembers the files. Each micro-batch is one load of the
    clean table, written under its batch number: a batch that is retried after
    a failure replaces its own load, and the first one replaces the table.
    """
    tune(spark)
    options = {"maxFilesPerTrigger": str(max_files)} if max_files else {}

    def load(batch: DataFrame, batch_id: int) -> None:
        load_table(batch, zones, table, load=batch_id, replace=batch_id == 0, strict=strict)

    query = (
        stream_raw(spark, zones, table, **options)
        .writeStream.queryName(f"clean_{table}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
    return query
