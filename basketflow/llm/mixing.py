"""Mixing sources to target weights by capped water-filling.

Every source should give words in proportion to its weight, but none more than
`epochs` times what it holds. Sources that would are clamped there and what
they cannot take is shared out again among the others by weight, until nothing
is left above a clamp. The level reached, words per unit of weight, is one
fraction, so a round of sharing is one aggregate over the sources.

A source then repeats all its documents as often as its target holds it whole.
What remains goes to one more repetition of some of its documents: the first in
the order of a seeded hash, the last of them cut. That border is found digit by
digit of the hash, from sums per digit, and at the end by sums over the rows
that share the hash it falls on. So a source, an id or a group of copies with a
large share of all rows is many tasks, no task sorts more than the digits of
a source, and every target is met to a word.

All of it is DataFrame expressions; texts are read once and never shuffled.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.ranks import ranked
from basketflow.session import stored

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 20240229
# Hashes are whole numbers below 2 ** HASH_BITS, with digits of DIGIT_BITS.
HASH_BITS, DIGIT_BITS = 60, 10

_WORD = "[^\\x20\\x09-\\x0D]+"
_BREAKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Runs of other than space and 0x09-0x0D; none in a null. Each word
    becomes one letter, so no list of words is made of a long text."""
    letters = F.translate(F.regexp_replace(text, _WORD, "x"), _BREAKS, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("bigint")


def seeded_hash(seed: int) -> Column:
    """A number by seed, id and text; a null id or text counts as empty."""
    none = F.lit("")
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), none), F.coalesce("text", none))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources with the weights in turn, by code point, null last."""
    placed = ranked(sources, F.col("source").isNull().asc(), F.col("source").asc(), name="place")
    turn = ((F.col("place") - 1) % len(weights)).cast("int")
    return placed.withColumn("weight", F.array(*map(F.lit, weights))[turn].cast("bigint")).drop("place")


def _wide(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _clamped(level: Fraction, epochs: int) -> Column:
    """Whether a source's share at this level is as much as it may give."""
    share = _wide(F.col("weight")) * F.lit(level.numerator).cast("decimal(38,0)")
    return _wide(F.col("source_size") * epochs) * F.lit(level.denominator).cast("decimal(38,0)") <= share


def water_level(sources: DataFrame, epochs: int = EPOCHS) -> Fraction:
    """Words per unit of weight, once nothing is left above a clamp.

    Each round clamps the sources above their limit and shares the rest among
    the others. The driver sees three sums a round."""
    total, weight = sources.agg(F.sum(_wide(F.col("source_size"))), F.sum(_wide(F.col("weight")))).first()
    level, clamps = Fraction(int(total or 0), int(weight or 1)), 0
    while True:
        over = sources.filter(_clamped(level, epochs))
        n, taken, off = over.agg(
            F.count("*"), F.sum(_wide(F.col("source_size") * epochs)), F.sum(_wide(F.col("weight")))
        ).first()
        if n == clamps or weight == off:
            return level
        clamps = n
        level = Fraction(int(total) - int(taken), int(weight) - int(off))


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """`sources` with `target` (words, a double), `whole` (repetitions of all
    its documents) and `extra` (words of one more repetition)."""
    level = water_level(sources, epochs)
    limit = F.col("source_size") * epochs
    clamped = _clamped(level, epochs)
    share = f"CAST(weight AS DECIMAL(38,0)) * CAST({level.numerator} AS DECIMAL(38,0))"
    down = f"CAST({level.denominator} AS DECIMAL(38,0))"
    exact = F.expr(f"CAST({share} AS DOUBLE) / CAST({down} AS DOUBLE)")
    words = sources.select(
        "*",
        F.when(clamped, limit.cast("double")).otherwise(exact).alias("target"),
        F.when(clamped, limit).otherwise(F.expr(f"({share}) DIV {down}")).alias("_words"),
    )
    return words.select(
        "*",
        F.expr("coalesce(_words DIV nullif(source_size, 0), 0L)").alias("whole"),
        F.expr("coalesce(_words % nullif(source_size, 0), 0L)").alias("extra"),
    ).drop("_words")


def _border(sums: DataFrame) -> DataFrame:
    """Of each source's `sums` by `prefix`, the one where its `_left` words run
    out, and how many of them are left for it."""
    before = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    run = sums.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    at = run.filter("_before < _left AND _left <= _before + _size")
    return at.select("source", F.col("prefix").alias("border"), (F.col("_left") - F.col("_before")).alias("_left"))


def _join(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """By source, null with null. One side has a row per source."""
    other = per_source.withColumnRenamed("source", "_source")
    return rows.join(other, rows["source"].eqNullSafe(other["_source"]), how).drop("_source")


def find_borders(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source of `plan` with `extra` words, the hash of the rows on which
    they run out, as `border`, and how many are left for these. The hash is
    found by one digit after the other; after the first, only rows that begin
    with what is known are read."""
    border = plan.filter("extra > 0").selectExpr("source", "0L AS border", "extra AS _left")
    inside = rows.select("source", "size", "hash")
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        prefix = F.shiftright("hash", shift)
        found = _join(inside.withColumn("prefix", prefix), border).filter(
            F.shiftright("prefix", DIGIT_BITS) == F.col("border")
        )
        sums = found.groupBy("source", "_left", "prefix").agg(F.sum("size").alias("_size"))
        border = stored(_border(sums), "borders")
        if shift == HASH_BITS - DIGIT_BITS:
            begun = _join(inside, border).filter(prefix == F.col("border"))
            inside = stored(begun.select("source", "size", "hash"), "rows-at-borders")
    return border


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, weight, target, whole, taken), one
    row per document. `size` counts words, `taken` those the mix takes of it,
    repetitions counted: `size` * `whole`, and up to `size` more.

    All sources together give as many words as they hold. A source's `taken`
    sum to its target, rounded down. A null source is one source, the last.
    A null text has no words and gives none; a source without words has target
    0. Rows alike in id and text may exchange their `taken`; all else follows
    from the seed. An empty table gives no rows."""
    rows = stored(
        documents.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            seeded_hash(seed).alias("hash"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "words-to-mix",
    )
    held = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    plan = stored(targets(stored(weighted(held, weights), "weighted-sources"), epochs), "targets")
    hash_border = find_borders(rows, plan).withColumnRenamed("border", "hash_border")

    # Whole documents up to the border, and of those on it what is left, in
    # the order of the rows: by sums per stretch of rows, then within one.
    planned = _join(_join(rows, plan), hash_border, "left")
    on_border = F.col("hash") == F.col("hash_border")
    before = F.coalesce(F.col("hash") < F.col("hash_border"), F.lit(False))
    clear = planned.filter(~F.coalesce(on_border, F.lit(False))).withColumn(
        "more", F.when(before, F.col("size")).otherwise(0)
    )
    edge = stored(planned.filter(on_border).withColumn("stretch", F.shiftright("tie", 33)), "border-rows")
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        edge.groupBy("source", "stretch")
        .agg(F.sum("size").alias("_size"))
        .select(F.col("source").alias("_source"), F.col("stretch").alias("_stretch"),
                F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("source", "stretch").orderBy("tie").rowsBetween(Window.unboundedPreceding, -1)
    same = edge["source"].eqNullSafe(starts["_source"]) & (edge["stretch"] == starts["_stretch"])
    placed = edge.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, same)
    rest = F.col("_left") - F.col("_start") - F.col("_within")
    cut = placed.withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), rest)))

    columns = ["doc_id", "source", "size", "source_size", "weight", "target", "whole"]
    taken = (F.col("size") * F.col("whole") + F.col("more")).cast("bigint").alias("taken")
    return clear.select(*columns, taken).unionByName(cut.select(*columns, taken))
