"""Row validation in one pass: each row gets the name of the first rule it
breaks, or null. Schema rules come first, in column order, then row rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions.casting import as_declared

RULE = "rule"


def fill_defaults(table: str, raw: DataFrame) -> DataFrame:
    defaults = schemas.DEFAULTS.get(table)
    return raw.fillna(defaults) if defaults else raw


def _typed(column: str) -> str:
    return f"typed_{column}"


def first_broken_rule(table: str) -> Column:
    breaks = [F.when(F.col(_typed(name)).isNull(), name) for name in schemas.columns(table)]
    for rule in schemas.ROW_RULES.get(table, []):
        breaks.append(F.when(~rule.holds(F.col(_typed(rule.column))), rule.name))
    return F.coalesce(*breaks)


def rule_names(table: str) -> list[str]:
    names = schemas.columns(table) + [rule.name for rule in schemas.ROW_RULES.get(table, [])]
    return list(dict.fromkeys(names))


def rule_counts(table: str) -> list[Column]:
    """Kept rows, and rows per broken rule."""
    broke = [F.count_if(F.col(RULE) == name).alias(name) for name in rule_names(table)]
    return [F.count_if(F.col(RULE).isNull()).alias("kept"), *broke]


def tag(
    table: str,
    raw: DataFrame,
    strict: bool = False,
    observation: Observation | str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """`raw` text rows with defaults filled, their typed values, and `rule`,
    beside the columns of `carry`.

    The rules are counted as rows pass by. That also keeps a later filter on
    `rule` above this projection, so each cell is parsed once per row.
    """
    text = raw.select(*(F.col(name).cast("string") for name in schemas.columns(table)), *carry)
    filled = fill_defaults(table, text)
    typed = filled.withColumns(
        {_typed(name): as_declared(F.col(name), kind, strict) for name, kind in schemas.declared(table)}
    )
    tagged = typed.withColumn(RULE, first_broken_rule(table))
    return tagged.observe(observation or f"clean_{table}", *rule_counts(table))


def kept(table: str, tagged: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows that broke no rule, as their declared types."""
    return tagged.filter(F.col(RULE).isNull()).select(
        *(F.col(_typed(name)).alias(name) for name in schemas.columns(table)), *carry
    )


def rejects(table: str, tagged: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows that broke a rule, as they were read."""
    return tagged.filter(F.col(RULE).isNotNull()).select(
        F.lit(table).alias("table"), RULE, *schemas.columns(table), *carry
    )


def tagged_keys(table: str, tagged: DataFrame) -> DataFrame:
    """The rule, and the typed keys by which tables refer to each other."""
    keys = sorted({r.key for r in schemas.REFERENCES if table in (r.child, r.parent)})
    return tagged.select(RULE, *(F.col(_typed(name)).alias(name) for name in keys))


def staged(table: str, tagged: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Tagged rows for writing once: typed columns if kept, and else the text."""
    bad = F.col(RULE).isNotNull()
    typed = [F.when(~bad, F.col(_typed(name))).alias(_typed(name)) for name in schemas.columns(table)]
    text = [F.when(bad, F.col(name)).alias(name) for name in schemas.columns(table)]
    return tagged.select(*typed, *text, RULE, *carry, bad.alias("rejected"))


def staged_kept(table: str, rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return kept(table, rows.filter(~F.col("rejected")), carry)


def staged_rejects(table: str, rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return rejects(table, rows.filter("rejected"), carry)


def clean(table: str, raw: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) rows of one raw table."""
    tagged = tag(table, raw, strict)
    return kept(table, tagged), rejects(table, tagged)


def quality_report(rejected: dict[str, DataFrame], orphaned: dict[str, DataFrame]) -> DataFrame:
    """Rows per (table, rule) that broke a rule or reference something missing."""
    parts = [frame.select("table", RULE) for frame in rejected.values()]
    children = {reference.name: reference.child for reference in schemas.REFERENCES}
    for name, frame in orphaned.items():
        parts.append(
            frame.select(F.lit(children[name]).alias("table"), F.lit(f"orphan_{name}").alias(RULE))
        )
    return reduce(DataFrame.unionByName, parts).groupBy("table", RULE).agg(F.count("*").alias("bad_rows"))
