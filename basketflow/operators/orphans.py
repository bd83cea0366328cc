"""Referential checks: child rows whose key has no parent. They are reported,
not removed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketflow import schemas


def orphans(tables: dict[str, DataFrame], reference: schemas.Reference) -> DataFrame:
    child, parent = tables[reference.child], tables[reference.parent]
    missing = child.join(parent.select(reference.key), reference.key, "left_anti")
    return missing.select(child.columns)


def all_orphans(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {reference.name: orphans(tables, reference) for reference in schemas.REFERENCES}
