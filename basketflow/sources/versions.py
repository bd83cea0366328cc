"""A small record kept as numbered versions: each is one JSON file, created
whole or not at all, and the highest number counts."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from basketflow.sources import files

SUFFIX = ".json"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.removesuffix(SUFFIX)) for name in files.names(spark, folder) if name.endswith(SUFFIX))


def newest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """(number, record) of the newest version; (-1, None) without any."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return -1, None
    return numbers[-1], json.loads(files.read_text(spark, f"{folder}/{numbers[-1]:09d}{SUFFIX}"))


def commit(spark: SparkSession, folder: str, number: int, record: dict) -> None:
    """Write version `number`, the one after what was read, and drop those
    before it. Of several writers of one number, all but one fail."""
    alone = not any(n >= number for n in _numbers(spark, folder))
    alone = alone and files.put_text(spark, f"{folder}/{number:09d}{SUFFIX}", json.dumps(record))
    # Others may have gone on, and dropped this number, while it was written.
    if not alone or max(_numbers(spark, folder)) > number:
        raise RuntimeError(f"another run has written version {number} of {folder}")
    for old in _numbers(spark, folder):
        if old < number:
            files.delete(spark, f"{folder}/{old:09d}{SUFFIX}")
