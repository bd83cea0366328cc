"""Object-change notifications: are they ours, and which tables do they touch?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow import schemas

PREFIX = "data/"
SOURCE = "aws:s3"

# The event names that count as a change.
EVENT_NAMES = [
    "ObjectCreated:Put",
    "ObjectCreated:Post",
    "ObjectCreated:Copy",
    "ObjectCreated:CompleteMultipartUpload",
    "ObjectRemoved:Delete",
    "ObjectRemoved:DeleteMarkerCreated",
]

SCHEMA = (
    "Records array<struct<eventSource: string, eventName: string, "
    "s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)


def _fault(record: Column, prefix: str) -> Column:
    """What is wrong with a record first, or null."""
    key = record["s3"]["object"]["key"]
    checks = {
        "source": record["eventSource"] == SOURCE,
        "event": record["eventName"].isin(EVENT_NAMES),
        "bucket": record["s3"]["bucket"]["name"].isNotNull(),
        "key": key.isNotNull(),
        "prefix": key.startswith(prefix),
    }
    return F.coalesce(
        *(F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in checks.items())
    )


def validate_notifications(messages: DataFrame, prefix: str = PREFIX, column: str = "value") -> DataFrame:
    """`messages` with `records`, `valid` and the first `reason` against it.

    One bad record spoils its whole message. A null counts as absent, and text
    that is not JSON as a message without records.
    """
    records = F.from_json(F.col(column), SCHEMA)["Records"]
    parsed = messages.withColumn("records", records)
    faults = F.filter(F.transform("records", lambda r: _fault(r, prefix)), lambda f: f.isNotNull())
    reason = F.when(F.coalesce(F.size("records"), F.lit(0)) < 1, "records").otherwise(F.get(faults, 0))
    return parsed.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def touched_tables(validated: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(table, removed): the declared tables that valid messages name, and
    whether any of them says that an object was removed. At most one row each.

    A table's objects are `<prefix><table>.csv` or lie in a folder of that name.
    """
    keys = validated.filter("valid").select(F.explode("records").alias("record"))
    name = F.substring_index(F.substr(F.col("record")["s3"]["object"]["key"], F.lit(len(prefix) + 1)), "/", 1)
    table = F.regexp_replace(name, r"\.csv$", "").alias("table")
    removed = F.col("record")["eventName"].startswith("ObjectRemoved:").alias("removed")
    named = keys.select(table, removed).filter(F.col("table").isin(list(schemas.DECLARED)))
    return named.groupBy("table").agg(F.bool_or("removed").alias("removed"))
