"""Re-clean the tables that object-change notifications name.

A notification only says that a table changed. What changed is found by
comparing the table's raw files with a bookmark of those already cleaned. The
bookmark knows for each file the load of the clean table that holds its rows,
so a file that is new, replaced or removed costs its own rows only, and the
loads of all others are left as they lie. A table is only emptied if a message
says that objects were removed: raw files that are missing without one are an
error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketflow import schemas
from basketflow.operators.notifications import touched_tables, validate_notifications
from basketflow.plans.cleaning import empty_table, load_files
from basketflow.session import tune
from basketflow.sources import files
from basketflow.sources.zones import Zones

# The files done, as the driver lists them, each with the load of its rows.
BOOKMARK = "path string, modified bigint, load bigint"
Files = dict[str, tuple[int, int]]


def _versions(spark: SparkSession, zones: Zones, table: str) -> list[int]:
    names = files.names(spark, zones.bookmark(table))
    done = (name for name in names if name.startswith("version="))
    return sorted(int(name.removeprefix("version=")) for name in done)


def _read_bookmark(spark: SparkSession, zones: Zones, table: str) -> Files | None:
    """The newest bookmark; none if the table was never cleaned, or if it says
    nothing of loads."""
    versions = _versions(spark, zones, table)
    if not versions:
        return None
    rows = spark.read.schema(BOOKMARK).parquet(f"{zones.bookmark(table)}/version={versions[-1]}")
    if not rows.filter("path <> '' AND load IS NULL").isEmpty():
        return None
    return {row["path"]: (row["modified"], row["load"]) for row in rows.filter("path <> ''").toLocalIterator()}


def _write_bookmark(spark: SparkSession, zones: Zones, table: str, done: Files) -> None:
    """The next version, then those before it go. A nameless entry marks it as
    written even if there are no files."""
    versions = _versions(spark, zones, table)
    rows = [("", 0, None), *((path, modified, load) for path, (modified, load) in done.items())]
    number = max(versions, default=-1) + 1
    listed = spark.createDataFrame(rows, BOOKMARK).coalesce(1)
    listed.write.mode("overwrite").parquet(f"{zones.bookmark(table)}/version={number}")
    for version in versions:
        files.delete(spark, f"{zones.bookmark(table)}/version={version}")


def refresh_table(
    spark: SparkSession, zones: Zones, table: str, strict: bool = False, removed: bool = False
) -> str:
    """Bring a clean table up to date with its raw files; returns what it did:
    "none", "append" (files came), "rewrite" (some were replaced or removed) or
    "rebuild" (nothing was known of the table).

    Without any raw file it empties the clean table if `removed` says that
    they were taken away, and else raises FileNotFoundError.

    Retrying after a failure repeats the same loads, since the bookmark moves
    last. The clean table must not be written by other jobs in between. Only
    the file system is asked what changed, and only changed files are opened.
    """
    raw = zones.raw_table(table)
    now = dict(files.listing(spark, raw)) if files.exists(spark, raw) else {}
    if not removed and not now:
        raise FileNotFoundError(f"no raw file at {raw}, and none was said to be removed")
    then = _read_bookmark(spark, zones, table)
    done = then or {}
    gone = [path for path in done if path not in now]
    replaced = [path for path in done if path in now and now[path] != done[path][0]]
    new = sorted(path for path in now if path not in done)
    if then is not None and not (gone or replaced or new):
        return "none"
    free = max((load for _, load in done.values()), default=-1) + 1
    loads = {path: done[path][1] for path in replaced} | {path: free + i for i, path in enumerate(new)}
    if not now:
        empty_table(spark, zones, table)
    else:
        if loads:
            # With no file done, what the table holds is not of these files.
            load_files(spark, zones, table, loads, anew=not done, strict=strict)
        for path in gone:
            for root in (zones.clean_table(table), zones.rejects(table)):
                files.delete(spark, f"{root}/load={done[path][1]}")
    kept = {path: (modified, done[path][1] if path in done else loads[path]) for path, modified in now.items()}
    _write_bookmark(spark, zones, table, kept)
    return "rebuild" if then is None else "rewrite" if gone or replaced else "append"


def on_notifications(
    spark: SparkSession,
    zones: Zones,
    inbox: str,
    checkpoint: str,
    then: Callable[[SparkSession, Zones], None] | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Work through the notifications in `inbox` (JSON text, one per line).

    Messages are validated as a stream; per micro-batch each table that valid
    ones name is refreshed, then `then` runs if anything changed. Keys count
    below the prefix of `zones`, where the raw files are looked for as well.
    """
    tune(spark)

    def handle(messages: DataFrame, batch_id: int) -> None:
        named = touched_tables(validate_notifications(messages, zones.prefix), zones.prefix)
        rows = sorted(named.take(len(schemas.DECLARED)))
        done = [refresh_table(spark, zones, row["table"], strict, row["removed"]) for row in rows]
        if then is not None and any(action != "none" for action in done):
            then(spark, zones)

    query = (
        spark.readStream.text(inbox)
        .writeStream.queryName("notifications")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
    return query
