"""Documents to packed training windows: five stages, each over all that the
stage before it kept.

1. toxicity       documents that the classifier rejects go
2. near_dedup     one document of each group of near copies stays (sets of
                  five-word shingles, linked from a similarity of 0.8 up)
3. substrings     words of passages that stand in an earlier document go, and
                  documents left without a word
4. decontaminate  documents that hold a benchmark item of eight words or more go
5. packing        the rest, as pieces of training windows

Stages 1 to 4 return the columns of `documents`; the last returns the pieces.
A document without id, or with one that repeats, is judged like any other, row
by row. In stages 2 and 3 those without id come after all others, and equal
ids go by a hash of the text: of a group of near copies the one of smallest id
stays, and a passage stays where it stands first. A null text stays null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import decontaminate, minhash, packing, spans, toxicity
from basketflow.llm.ranks import ids_are_keys, numbered
from basketflow.llm.texts import prepare, table
from basketflow.session import stored

# Shingle sets that share so much of their union are near copies.
NEAR_PERCENT = 80
# A benchmark item of fewer words does not cost a document its place.
LEAST_ITEM = 8
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score below one half."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model, COLUMNS).filter("score < 0.5").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each component of near copies."""
    prepare(spark)
    return minhash.keep_first(docs.select(*COLUMNS), NEAR_PERCENT).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 words and more that an earlier document has. A text
    that loses words is joined anew by single spaces; one that loses all goes.
    Texts that had no word to begin with stay as they are."""
    prepare(spark)
    docs, own_id = docs.select(*COLUMNS), "doc_id"
    carry = COLUMNS[2:4]
    if not ids_are_keys(docs):
        own_id = "own_id"
        carry = [*carry, own_id]
        docs = numbered(docs.withColumn(own_id, F.col("doc_id")), "row_number")
        docs = docs.withColumn("doc_id", F.col("row_number"))
    kept = spans.remove_repeats(docs, keep_text=True, carry=carry)
    left = kept.filter("n_removed = 0 OR n_removed < n_words")
    return left.select(
        F.col(own_id).alias("doc_id"),
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.length("kept_text").cast("bigint").alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which no benchmark item of LEAST_ITEM words and
    more is found: a shorter one is a phrase that any text may hold."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    benchmark = table(spark, sf_dir, "benchmark").filter(words >= LEAST_ITEM)
    found = decontaminate.found_items(docs.select(*COLUMNS), benchmark, COLUMNS)
    return found.filter(F.size("found") == 0).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document, cut and packed into windows of 1,024 tokens."""
    prepare(spark)
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_each_group),
    ("substrings", drop_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("packing", pack_windows),
]

# SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
