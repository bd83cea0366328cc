"""The scored table: keyed upsert and top products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["user_id", "product_id"]
SCORE = "predicted_probability"


def _score():
    """A probability given as number or text; missing, unreadable or not a
    number is 0."""
    return F.coalesce(F.nanvl(F.col(SCORE).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def newest(batch: DataFrame, version: str | None = None) -> DataFrame:
    """One row per key: the latest by `version` if given, then the highest."""
    order = ([F.col(version).desc_nulls_last()] if version else []) + [
        _score().desc(),
        F.col(SCORE).cast("string").asc_nulls_last(),
    ]
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(*order))
    return batch.withColumn("_place", place).filter("_place = 1").select(*KEY, SCORE)


def untouched(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows whose key `new` does not have. Only the keys of `new` are asked
    for, so what computes its scores is not run for this. Old rows only pass an
    anti-join: a small batch, which Spark broadcasts, leaves them unshuffled."""
    return old.select(*KEY, SCORE).join(new.select(KEY), KEY, "left_anti")


def upsert_predictions(old: DataFrame, new: DataFrame, version: str | None = None) -> DataFrame:
    """`old`, unique by key, with the rows of `new` added or put in their place."""
    return untouched(old, new).unionByName(newest(new, version))


def top_k(predictions: DataFrame, k: int = 3, user_id: str | None = None) -> DataFrame:
    """The k likeliest products of one user, or of every user, best first.

    Ties go by product id as text. Spark keeps k rows per user and task before
    it shuffles, so a user with a large share of the table costs no more.
    """
    if user_id is not None:
        predictions = predictions.filter(F.col("user_id") == require_user(user_id))
    best = Window.partitionBy("user_id").orderBy(_score().desc(), F.col("product_id").cast("string"))
    return (
        predictions.withColumn("position", F.row_number().over(best))
        .filter(F.col("position") <= k)
        .select(*KEY, SCORE, "position")
    )


def require_user(user_id: str | None) -> str:
    if not user_id:
        raise ValueError("user_id is required")
    return str(user_id)


def lookup(predictions: DataFrame, user_id: str | None, k: int = 3) -> DataFrame:
    """`top_k` of one user; a missing or empty id is the caller's error."""
    return top_k(predictions, k, require_user(user_id)).orderBy("position")
