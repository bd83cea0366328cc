"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Queries and candidates meet in blocks. A block of candidates is turned into
postings, one list of (row, weight) per component; each component of a query
scatters its weighted postings into a dense array of scores, from which the
best k are selected. The k best of each block are merged per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))),
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of every usable vector with an id, as
    doubles, which hold these whole numbers exactly. From 2**53 on every double
    is whole, and Spark's floor would end at the largest long."""

    def whole(x: Column) -> Column:
        scaled = F.lit(scale) * x.cast("double")
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    weights = F.transform("embedding", whole)
    return vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint"), weights.alias("weights")
    )


def number_type(asked: list[np.ndarray], there: list[np.ndarray]) -> type:
    """Longs, if no sum of products of these vectors can leave them; else
    Python's whole numbers, which are slow and never wrap."""
    most = [max((float(np.abs(v).max()) for v in side if len(v)), default=0.0) for side in (asked, there)]
    width = max((len(v) for v in there), default=0)
    return np.int64 if max(most) < 2.0**62 and most[0] * most[1] * width < 2.0**62 else object


def as_whole(vector: np.ndarray, kind: type) -> np.ndarray:
    return vector.astype(np.int64) if kind is np.int64 else np.array([int(x) for x in vector], object)


def postings(vectors: list[np.ndarray], kind: type = np.int64) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each component, the rows where it is not zero and its values."""
    width = max((len(v) for v in vectors), default=0)
    table = np.zeros((width, len(vectors)), kind)
    for row, vector in enumerate(vectors):
        table[: len(vector), row] = as_whole(vector, kind)
    rows = [np.flatnonzero(column) for column in table]
    return [(at, column[at]) for at, column in zip(rows, table)]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query, both sides as
    `quantised` makes them. A query's own row is no candidate: where several
    rows have its id, the others are, also those with the same vector.

    Vectors of different lengths are compared as if padded with zeros. A
    candidate row that repeats is a candidate each time, and a query row that
    repeats is answered each time; its search is made once. A score among the
    best that is no long is an error. Without queries or candidates there are
    no rows."""
    row = F.xxhash64("vec_id", "weights").alias("row")
    asked = queries.groupBy("vec_id", "weights").agg(F.count("*").alias("copies")).withColumn("row", row)
    there = candidates.select("vec_id", "weights", row)
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-there.count() // CANDIDATE_BLOCK))

    def dealt(rows: DataFrame, own: str, mine: int, other: str, theirs: int) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(theirs - 1)))
        return rows.select("*", F.pmod("row", F.lit(mine)).alias(own), everywhere.alias(other))

    def search(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        ids, rows = there["vec_id"].to_numpy(), there["row"].to_numpy()
        kind = number_type(list(asked["weights"]), list(there["weights"]))
        lists = postings(list(there["weights"]), kind)
        found = []
        for query, vector, row, copies in zip(asked["vec_id"], asked["weights"], asked["row"], asked["copies"]):
            scores = np.zeros(len(ids), kind)
            for (at, values), weight in zip(lists, as_whole(vector, kind)):
                if weight:
                    scores[at] += weight * values
            # Rows equal to the query's lie in one block; one of them is its own.
            own = np.flatnonzero((ids == query) & (rows == row))[:1]
            others = np.delete(np.arange(len(ids)), own)
            top = others[best(scores[others], ids[others], k)]
            found.append(
                pd.DataFrame(
                    {"query_id": query, "row": row, "copies": copies, "vec_id": ids[top], "score": scores[top]}
                )
            )
        columns = ["query_id", "row", "copies", "vec_id", "score"]
        return pd.concat(found).astype("int64") if found else pd.DataFrame(columns=columns, dtype="int64")

    pairs = dealt(asked, "q", q_blocks, "c", c_blocks).groupBy("q", "c").cogroup(
        dealt(there, "c", c_blocks, "q", q_blocks).groupBy("q", "c")
    )
    local = pairs.applyInPandas(search, "query_id bigint, row bigint, copies bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    ranked = local.withColumn("rank", rank).filter(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return ranked.select("query_id", "rank", "vec_id", "score", again.alias("copy")).drop("copy")
