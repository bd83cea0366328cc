"""Reading text cells as their declared type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole number followed by a decimal point and optional digits. Old casts to
# bigint cut the fraction off, so "1.5" counts as 1 and ".5" as 0.
_DECIMAL = r"^([\s\p{Cntrl}]*)(?<sign>[+-]?)(?<whole>\d*)\.\d*[\s\p{Cntrl}]*$"


def as_declared(cell: Column, kind: str, strict: bool = False) -> Column:
    """`cell` as `kind`, or null when it cannot be read.

    `strict` turns the truncation of decimal text to bigint off. The rewrite is
    the second argument of a coalesce, so only cells that the plain cast
    rejects ever reach the regular expression.
    """
    plain = cell.try_cast(kind)
    if kind != "bigint" or strict:
        return plain
    truncated = F.regexp_replace(cell.cast("string"), _DECIMAL, "${sign}0${whole}")
    return F.coalesce(plain, truncated.try_cast(kind))
