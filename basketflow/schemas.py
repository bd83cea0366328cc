"""Declared tables, the rules their rows must meet, and how tables refer to
each other. All of it is data; the operators interpret it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The column names and types of the five input tables.
DECLARED = {
    "aisles": _table(aisle_id=T.LongType(), aisle=T.StringType()),
    "departments": _table(department_id=T.LongType(), department=T.StringType()),
    "products": _table(
        product_id=T.LongType(),
        product_name=T.StringType(),
        aisle_id=T.LongType(),
        department_id=T.LongType(),
    ),
    "orders": _table(
        order_id=T.LongType(),
        user_id=T.LongType(),
        eval_set=T.StringType(),
        order_number=T.LongType(),
        order_dow=T.LongType(),
        order_hour_of_day=T.LongType(),
        days_since_prior_order=T.DoubleType(),
    ),
    "order_products": _table(
        order_id=T.LongType(),
        product_id=T.LongType(),
        add_to_cart_order=T.LongType(),
        reordered=T.LongType(),
    ),
}


def declared(table: str) -> list[tuple[str, str]]:
    """(column, type name) pairs in declared order."""
    return [(field.name, field.dataType.simpleString()) for field in typed_schema(table)]


def columns(table: str) -> list[str]:
    return [name for name, _ in declared(table)]


def typed_schema(table: str) -> T.StructType:
    return DECLARED[table]


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns(table)])


# Nulls replaced before any rule is checked.
DEFAULTS = {"orders": {"days_since_prior_order": "-1"}}


@dataclass(frozen=True)
class RowRule:
    """A row breaks the rule when `holds`, given the typed column, is not true."""

    name: str
    column: str
    holds: Callable[[Column], Column]


ROW_RULES = {
    "orders": [
        RowRule("order_dow", "order_dow", lambda day: day.between(0, 6)),
        RowRule("order_hour", "order_hour_of_day", lambda hour: hour.between(0, 23)),
    ],
    "order_products": [
        RowRule("reordered", "reordered", lambda flag: flag.isin(0, 1)),
    ],
}


@dataclass(frozen=True)
class Reference:
    """Every `child` row should find its `key` in `parent`."""

    name: str
    child: str
    parent: str
    key: str


REFERENCES = [
    Reference("aisle", "products", "aisles", "aisle_id"),
    Reference("department", "products", "departments", "department_id"),
    Reference("product", "order_products", "products", "product_id"),
    Reference("order", "order_products", "orders", "order_id"),
]


def is_training_target() -> Column:
    """Orders to learn from or predict, as opposed to purchase history."""
    return F.col("eval_set") != "prior"


# The columns of the training and test sets, in order.
ML_COLUMNS = [
    "product_id",
    "user_id",
    "eval_set",
    "reordered",
    "up_orders",
    "up_reorders",
    "up_first_order",
    "up_last_order",
    "up_avg_add_to_cart_order",
    "up_avg_time_since_last_order",
    "user_orders",
    "user_total_products",
    "user_period",
    "user_mean_days_since_prior",
    "user_distinct_products",
    "user_reorder_ratio",
    "weekend_order_ratio",
    "user_average_basket",
    "up_order_rate",
    "up_orders_since_last_order",
    "up_order_rate_since_first_order",
    "prod_orders",
    "prod_avg_cart_position",
    "prod_reorder_rate",
    "prod_reorder_probability",
    "prod_reorder_times",
    "product_name",
]
