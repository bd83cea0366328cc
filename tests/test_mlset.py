"""The labelled set against the plain join chain, repeats included."""

import pytest
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions.copies import repeat_rows
from basketflow.operators import mlset, purchases
from basketflow.operators.mlset import PRODUCT_MEASURES
from basketflow.operators.purchases import PAIR

# user 1: two target orders; user 2: one; user 3: a target order but no history
ORDERS = [
    (1, 1, "prior", 1, 0, 8, -1.0),
    (2, 1, "prior", 2, 2, 8, 3.0),
    (3, 1, "train", 3, 2, 8, 3.0),
    (4, 1, "test", 4, 2, 8, 3.0),
    (5, 2, "prior", 1, 6, 8, -1.0),
    (6, 2, "test", 2, 1, 8, 9.0),
    (7, 3, "train", 1, 1, 8, -1.0),
]
# order 3 lists product 10 three times, with both labels; product 77 is unknown
LINES = [
    (1, 10, 1, 0),
    (2, 10, 1, 1),
    (2, 11, 2, 0),
    (3, 10, 1, 1),
    (3, 10, 2, 1),
    (3, 10, 3, 0),
    (3, 12, 4, 0),
    (4, 10, 1, 1),
    (4, 77, 2, 0),
    (5, 11, 1, 0),
    (6, 11, 1, 1),
    (7, 10, 1, 0),
    (99, 10, 1, 0),
]
PRODUCTS = [(10, "ten", 1, 1), (11, "eleven", 1, 1), (12, "twelve", 1, 1)]


@pytest.fixture(scope="module")
def parts(spark):
    orders = spark.createDataFrame(ORDERS, schemas.typed_schema("orders"))
    lines = spark.createDataFrame(LINES, schemas.typed_schema("order_products"))
    products = spark.createDataFrame(PRODUCTS, schemas.typed_schema("products"))
    prior = purchases.prior_lines(lines, orders)
    occasions = purchases.occasions(prior)
    pairs = purchases.pair_totals(occasions)
    return {
        "orders": orders,
        "lines": lines,
        "products": products,
        "up": purchases.user_product_features(pairs),
        "users": purchases.user_features(pairs),
        "product_features": purchases.product_features(pairs, occasions),
    }


def compact(p):
    return mlset.assemble(
        p["orders"],
        p["lines"],
        p["up"],
        mlset.target_users(p["users"], mlset.target_orders(p["orders"])),
        mlset.product_side(p["products"], p["product_features"]),
    )


def plain_chain(p):
    """Every join as it stands, with repeated rows on both sides."""
    targets = mlset.target_orders(p["orders"])
    label_rows = mlset.labels(targets, p["lines"])
    users = p["users"].drop("total_reorders").join(targets.select("user_id"), "user_id")
    left = mlset.attach_up(label_rows, p["up"]).join(users, "user_id", "left")
    right = (
        label_rows.select("product_id", "order_id")
        .join(p["product_features"].select("product_id", *PRODUCT_MEASURES), "product_id", "left")
        .fillna(0)
    )
    crossed = mlset.cross_features(left).join(right, ["product_id", "order_id"])
    return label_rows, crossed.join(p["products"], "product_id").select(schemas.ML_COLUMNS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repeats_are_those_of_the_join_chain(parts):
    _, expected = plain_chain(parts)
    got = repeat_rows(compact(parts))
    assert got.columns == schemas.ML_COLUMNS
    assert rows(got) == rows(expected)
    # product 10 of order 3: three listings squared, for each of two target orders
    assert got.filter("eval_set = 'train' AND user_id = 1 AND product_id = 10").count() == 18


def test_labels_with_features_is_the_left_join(parts):
    label_rows, final = plain_chain(parts)
    features = final.drop("eval_set", "reordered")
    expected = label_rows.drop("order_id").join(features, PAIR, "left")
    got = repeat_rows(mlset.labels_with_features(label_rows, compact(parts)))
    assert rows(got) == rows(expected.select(got.columns))


def test_first_purchase_of_a_known_user(parts):
    row = repeat_rows(compact(parts)).filter("user_id = 1 AND product_id = 12").first()
    assert (row.up_orders, row.up_last_order, row.prod_orders) == (0, 0, 0)
    assert row.up_orders_since_last_order == row.user_orders == 2
    assert row.up_order_rate_since_first_order == 0.0


def test_user_without_history_keeps_nulls_and_is_not_repeated(parts):
    got = repeat_rows(compact(parts)).filter("user_id = 3").collect()
    assert len(got) == 1
    assert got[0].user_orders is None and got[0].up_order_rate is None and got[0].up_orders == 0


def test_unknown_products_drop_out(parts):
    assert repeat_rows(compact(parts)).filter("product_id = 77").count() == 0


def test_user_restriction_repeats_per_target_order(parts):
    users = repeat_rows(mlset.target_users(parts["users"], mlset.target_orders(parts["orders"])))
    assert sorted(r.user_id for r in users.collect()) == [1, 1, 2]
    assert "total_reorders" not in users.columns


def test_attach_user_without_copies_column_is_one_each(parts):
    labels = mlset.labels(mlset.target_orders(parts["orders"]), parts["lines"]).withColumn("copies", F.lit(1))
    users = mlset.target_users(parts["users"], mlset.target_orders(parts["orders"]))
    got = repeat_rows(mlset.attach_user(labels, users))
    assert got.filter("user_id = 1").count() == 2 * 6
