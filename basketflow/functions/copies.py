"""Row multiplicity kept as a number instead of as repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 16_384


def repeat_rows(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row `copies` times over, without the `copies` column.

    Rows of up to a chunk of copies, nearly all, are repeated where they are.
    The others are first cut into chunks, which are rebalanced, so that the
    copies of one hot row are shared out over many tasks.
    """
    few = df.filter((F.col(copies) > 0) & (F.col(copies) <= CHUNK))
    last = F.expr(f"({copies} - 1) DIV {CHUNK}L")
    many = (
        df.filter(F.col(copies) > CHUNK)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .hint("rebalance")
    )
    rest = F.least(F.lit(CHUNK), F.col(copies) - F.col("_chunk") * F.lit(CHUNK))
    chunks = many.withColumn(copies, rest).drop("_chunk").select(df.columns)
    repeated = few.unionByName(chunks)
    take = F.sequence(F.lit(1), F.col(copies).cast("int"))
    return repeated.withColumn("_copy", F.explode(take)).drop(copies, "_copy")
