"""Null-safe ratios: a zero or missing denominator gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column | str, bottom: Column | str) -> Column:
    return F.try_divide(_col(top), _col(bottom))


def ratio2(top: Column | str, bottom: Column | str) -> Column:
    """Two-decimal ratio, halves rounded up."""
    return F.round(ratio(top, bottom), 2)


def count_if(condition: Column) -> Column:
    """Rows meeting `condition`, 0 (not null) when there are none."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
