"""Shards by a Feistel permutation of global row numbers.

Rows get global numbers, a keyed Feistel network permutes the numbers at random,
and the permuted number p goes to shard p mod k at slot p div k. So counts
differ by one at most, slots have no gap, and anyone who knows the key, the row
number and the number of rows can tell shard and slot without the table. Only ids, sizes and checksums are shuffled, no text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.texts import mix
from basketflow.session import stored

ROUNDS = 6


def permute(numbers: np.ndarray, rows: int, key: int) -> np.ndarray:
    """A permutation of 0 .. rows - 1: Feistel rounds on the smallest even
    number of bits that holds them, applied again while the result is not
    below `rows` (cycle walking)."""
    half = np.uint64(max(1, (max(rows - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [mix(np.array([key * ROUNDS + r + 1], np.uint64))[0] for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << half) | right

    out = once(numbers.astype(np.uint64))
    while (outside := np.flatnonzero(out >= np.uint64(rows))).size:
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def numbered(rows: DataFrame, order: list[str], by: list[str] | None = None, per_part: int = 250_000) -> DataFrame:
    """`rows`, which must be stored, with a 0-based `number` (within each `by`, if given).

    Rows are dealt by a hash of `order` and numbered within their part, then
    moved on by the rows of the parts before. No key lands in one task, and
    only the counts of the parts are added up. Rows equal in all of `order`
    are interchangeable.
    """
    by = by or []
    parts = max(1, -(-rows.count() // per_part))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*order, F.lit(71)), F.lit(parts)))
    sizes = dealt.groupBy(*by, "part").agg(F.count("*").alias("in_part"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("part_start"))
    place = F.row_number().over(Window.partitionBy(*by, "part").orderBy(*order)) - 1
    out = dealt.withColumn("place", place).join(starts, [*by, "part"])
    return out.select(*rows.columns, (F.col("part_start") + F.col("place")).cast("bigint").alias("number"))


def row_numbers(rows: DataFrame, key: list[str], tie: str, per_part: int = 250_000, hot: int = 50_000) -> DataFrame:
    """`rows`, which must be stored, with a 0-based `number` that follows from
    the columns of `key` alone, whatever files the rows lie in.

    Rows are dealt by a hash of the key and placed within their part; `tie`, a
    `monotonically_increasing_id`, only decides between rows with the same key.
    A key with more than `hot` rows follows after all others, in a part for
    each stretch of rows that was read together, as its rows are alike."""
    parts = max(1, -(-rows.count() // per_part))
    dealt = rows.withColumns(
        {"part": F.pmod(F.xxhash64(*key, F.lit(71)), F.lit(parts)).cast("bigint"), "stretch": F.lit(0).cast("bigint")}
    )
    many = stored(rows.groupBy(*key).agg(F.count("*").alias("alike")).filter(F.col("alike") > hot), "hot-rows")
    if not many.isEmpty():
        after = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*key)) - 1 + parts
        names = [f"_{name}" for name in key]
        late = many.select(after.cast("bigint").alias("_part"), *(F.col(name).alias(f"_{name}") for name in key))
        same = reduce(Column.__and__, (dealt[name].eqNullSafe(late[other]) for name, other in zip(key, names)))
        dealt = dealt.join(late, same, "left").withColumns(
            {
                "part": F.coalesce("_part", "part"),
                "stretch": F.when(F.col("_part").isNotNull(), F.shiftright(tie, 33)).otherwise(0),
            }
        )
    sizes = dealt.groupBy("part", "stretch").agg(F.count("*").alias("in_part"))
    before = Window.partitionBy(F.lit(0)).orderBy("part", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "stretch", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("part_start"))
    place = F.row_number().over(Window.partitionBy("part", "stretch").orderBy(*key, tie)) - 1
    out = dealt.withColumn("place", place).join(starts, ["part", "stretch"])
    return out.select(*rows.columns, (F.col("part_start") + F.col("place")).cast("bigint").alias("number"))


def shards(
    documents: DataFrame, count: int = 24, key: int = 20240229, per_part: int = 250_000, hot: int = 50_000
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, number), one row per document.

    `size` is the text's UTF-8 bytes plus 8, a null text having none. A row's
    number, and so its place, follows from the ids, checksums and sizes of the
    table, not from its files. Rows equal in these are alike, so which of them
    gets which number does not show; null ids are numbered like others. An
    empty table gives no rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "rows-to-shard",
    )
    total = rows.count()
    with_number = row_numbers(rows, ["doc_id", "text_crc32", "size"], "tie", per_part, hot)
    fields = "doc_id bigint, size bigint, text_crc32 bigint, number bigint, shard int, slot bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = permute(batch.column("number").to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((to % count).astype(np.int32)), pa.array(to // count)],
                names=["doc_id", "size", "text_crc32", "number", "shard", "slot"],
            )

    columns = with_number.select(F.col("doc_id").cast("bigint"), "size", "text_crc32", "number")
    return columns.mapInArrow(place, fields)
