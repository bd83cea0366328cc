"""The labelled set: products in each target order with history features.

Repeated rows are carried as a `copies` count: labels repeat when an order
lists a product more than once, and users when they have several target orders.
Joins then run over distinct keys with unique right sides, and only the end of
a chain repeats rows (`repeat_rows`), giving the rows of the plain join chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions.ratios import ratio2
from basketflow.operators.purchases import PAIR

PRODUCT_MEASURES = [name for name in schemas.ML_COLUMNS if name.startswith("prod_")]
FEATURES = schemas.ML_COLUMNS[4:]


def target_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(schemas.is_training_target()).select("user_id", "order_id", "eval_set")


def labels(targets: DataFrame, order_products: DataFrame) -> DataFrame:
    """Lines of the target orders; `reordered` is the label."""
    return targets.join(order_products.select("order_id", "product_id", "reordered"), "order_id")


def distinct_labels(label_rows: DataFrame) -> DataFrame:
    """Distinct labels with their `copies`, and `listed`: how often the order
    lists the product, whatever the label."""
    listed = Window.partitionBy("order_id", "product_id")
    return (
        label_rows.groupBy("order_id", "product_id", "user_id", "eval_set", "reordered")
        .agg(F.count("*").alias("copies"))
        .withColumn("listed", F.sum("copies").over(listed))
    )


def target_users(user_features: DataFrame, targets: DataFrame) -> DataFrame:
    """Features of users with a target order; `copies` counts those orders."""
    users = targets.groupBy("user_id").agg(F.count("*").alias("copies"))
    return user_features.drop("total_reorders").join(users, "user_id")


def attach_up(label_rows: DataFrame, up_features: DataFrame) -> DataFrame:
    """Features of the (user, product) pair, zero for a first purchase."""
    return label_rows.join(up_features, PAIR, "left").fillna(0)


def attach_product(label_rows: DataFrame, product_features: DataFrame) -> DataFrame:
    """Features of the product, zero if it was never bought before."""
    measures = product_features.select("product_id", *PRODUCT_MEASURES)
    return label_rows.join(measures, "product_id", "left").fillna(0)


def attach_user(rows: DataFrame, users: DataFrame) -> DataFrame:
    """User features; null for users without history, who are not repeated."""
    per_user = users.withColumnRenamed("copies", "_user_copies")
    joined = rows.join(per_user, "user_id", "left")
    repeats = F.col("copies") * F.coalesce("_user_copies", F.lit(1))
    return joined.withColumn("copies", repeats).drop("_user_copies")


def cross_features(rows: DataFrame) -> DataFrame:
    """The names of the three columns."""
    since_first = F.col("user_orders") - F.col("up_first_order") + 1
    return rows.withColumns(
        {
            "up_order_rate": ratio2("up_orders", "user_orders"),
            "up_orders_since_last_order": F.col("user_orders") - F.col("up_last_order"),
            "up_order_rate_since_first_order": ratio2(F.col("up_orders"), since_first),
        }
    )


def product_side(products: DataFrame, product_features: DataFrame) -> DataFrame:
    """Known products with name and features, joined once before the labels."""
    return attach_product(products.select("product_id", "product_name"), product_features)


def assemble(
    orders: DataFrame,
    order_products: DataFrame,
    up_features: DataFrame,
    users: DataFrame,
    product_side: DataFrame,
) -> DataFrame:
    """The ML set in compact form: distinct rows with `copies`.

    A product listed n times in an order yields each of its rows n times (see
    `repeated_lines`). An order belongs to one split, so `orders` may be
    filtered to a split beforehand, which reaches the scan. The sides joined to
    the labels should be stored tables: Spark then knows their sizes, broadcasts
    those that are small, and splits the labels' hot users and products when
    they are not.
    """
    rows = distinct_labels(labels(target_orders(orders), order_products))
    rows = attach_user(attach_up(rows, up_features), users)
    rows = cross_features(rows).withColumn("copies", F.col("copies") * F.col("listed"))
    return rows.join(product_side, "product_id").select(*schemas.ML_COLUMNS, "copies")


def repeated_lines(order_products: DataFrame) -> DataFrame:
    """(order_id, product_id, listed) of products that an order lists more than
    once; each adds listed ** 2 rows to the labelled set instead of one."""
    listed = order_products.groupBy("order_id", "product_id").agg(F.count("*").alias("listed"))
    return listed.filter("listed > 1")


def split(ml_set: DataFrame, eval_set: str) -> DataFrame:
    return ml_set.filter(F.col("eval_set") == eval_set)


def labels_with_features(label_rows: DataFrame, compact: DataFrame) -> DataFrame:
    """All labels, with the ML set's features of their (user, product) if it has
    any, in compact form. Features depend on the pair alone, so the ML set is
    first reduced to one row per pair."""
    features = (F.any_value(name).alias(name) for name in FEATURES)
    per_pair = compact.groupBy(PAIR).agg(*features, F.sum("copies").alias("_matches"))
    per_label = label_rows.groupBy(*PAIR, "eval_set", "reordered").agg(F.count("*").alias("copies"))
    joined = per_label.join(per_pair, PAIR, "left")
    repeats = F.col("copies") * F.coalesce("_matches", F.lit(1))
    return joined.withColumn("copies", repeats).select(
        *PAIR, "eval_set", "reordered", *FEATURES, "copies"
    )
