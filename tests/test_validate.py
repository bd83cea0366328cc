"""Casts, defaults, rules and routing of raw rows."""

import pytest
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions.casting import as_declared
from basketflow.operators import orphans, validate

# text, as bigint the lenient way, as bigint strictly
CELLS = [
    ("", None, None),
    (None, None, None),
    ("abc", None, None),
    ("1.5", 1, None),
    (" 7 ", 7, 7),
    ("1e2", None, None),
    ("15.0", 15, None),
    (".5", 0, None),
    ("-2.9", -2, None),
    ("+3.", 3, None),
    ("1.5x", None, None),
    ("-", None, None),
    ("99999999999999999999", None, None),
    ("99999999999999999999.0", None, None),
]


@pytest.mark.parametrize("text, lenient, strict", CELLS)
def test_bigint_cells(spark, text, lenient, strict):
    cell = spark.createDataFrame([(text,)], "cell string")
    row = cell.select(
        as_declared(F.col("cell"), "bigint").alias("lenient"),
        as_declared(F.col("cell"), "bigint", strict=True).alias("strict"),
    ).first()
    assert (row.lenient, row.strict) == (lenient, strict)


def test_double_and_string_cells(spark):
    cells = spark.createDataFrame([("1e2",), ("x",), (None,)], "cell string")
    got = cells.select(as_declared(F.col("cell"), "double"), as_declared(F.col("cell"), "string")).collect()
    assert [tuple(r) for r in got] == [(100.0, "1e2"), (None, "x"), (None, None)]


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.text_schema("orders"))


GOOD = ("1", "10", "prior", "1", "3", "9", "2.0")


def changed(**cells):
    row = dict(zip(schemas.columns("orders"), GOOD))
    row.update(cells)
    return tuple(row.values())


@pytest.mark.parametrize(
    "cells, rule",
    [
        ({}, None),
        ({"order_dow": "7"}, "order_dow"),
        ({"order_dow": "-1"}, "order_dow"),
        ({"order_hour_of_day": "24"}, "order_hour"),
        ({"order_hour_of_day": "noon"}, "order_hour_of_day"),
        ({"user_id": "abc", "order_dow": "9"}, "user_id"),
        ({"order_dow": "9", "order_hour_of_day": "99"}, "order_dow"),
        ({"eval_set": None}, "eval_set"),
        ({"days_since_prior_order": None}, None),
        ({"days_since_prior_order": "soon"}, "days_since_prior_order"),
    ],
)
def test_a_row_goes_to_its_first_broken_rule(spark, cells, rule):
    kept, rejected = validate.clean("orders", orders(spark, changed(**cells)))
    assert [r.rule for r in rejected.collect()] == ([rule] if rule else [])
    assert kept.count() == (0 if rule else 1)


def test_kept_rows_are_typed_and_first_orders_get_minus_one(spark):
    kept, _ = validate.clean("orders", orders(spark, changed(days_since_prior_order=None)))
    assert kept.schema == schemas.typed_schema("orders")
    assert tuple(kept.first()) == (1, 10, "prior", 1, 3, 9, -1.0)


def test_rejects_keep_the_text(spark):
    _, rejected = validate.clean("orders", orders(spark, changed(user_id=" 1x")))
    row = rejected.first()
    assert (row["table"], row.rule, row.user_id) == ("orders", "user_id", " 1x")


@pytest.mark.parametrize("flag, good", [("0", True), ("1", True), ("01", True), ("2", False), ("yes", False)])
def test_reordered_is_a_flag(spark, flag, good):
    raw = spark.createDataFrame([("1", "2", "3", flag)], schemas.text_schema("order_products"))
    kept, _ = validate.clean("order_products", raw)
    assert kept.count() == int(good)


def test_kept_and_rejected_make_up_the_input(spark):
    from conftest import SMALL

    from basketflow.testbed import mapping

    for table in schemas.DECLARED:
        raw = mapping.dirty(spark, SMALL, table)
        kept, rejected = validate.clean(table, raw)
        assert kept.count() + rejected.count() == raw.count()


def test_orphans_are_whole_child_rows(spark):
    child = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 9, 1), (3, "c", 9, 1)], schemas.typed_schema("products"))
    parent = spark.createDataFrame([(1, "x"), (1, "again")], schemas.typed_schema("aisles"))
    missing = orphans.orphans({"products": child, "aisles": parent}, schemas.REFERENCES[0])
    assert missing.columns == child.columns
    assert sorted(r.product_id for r in missing.collect()) == [2, 3]
