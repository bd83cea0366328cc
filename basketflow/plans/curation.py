"""Clean zone to curated zone: history, features, ML set.

Purchase history, its occasions and the pair totals are each written once and
read back, so no later write repeats the join or the big aggregation, and a lost executor
costs at most the step it was working on. The two tables joined to the labels
are written too: a join between plain scans is one whose hot keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketflow.operators import mlset, purchases
from basketflow.session import sized_shuffles, tune
from basketflow.sources import files, readers, writers
from basketflow.sources.zones import Zones

HISTORY = "order_products_prior"
OCCASIONS = "_occasions"
TOTALS = "_pair_totals"
USERS = "_target_users"
NAMED = "_named_products"


def write_features(spark: SparkSession, zones: Zones) -> None:
    lines = readers.read_clean(spark, zones, "order_products")
    orders = readers.read_clean(spark, zones, "orders")
    writers.write_curated(purchases.prior_lines(lines, orders), zones, HISTORY)
    prior = readers.read_curated(spark, zones, HISTORY)
    writers.write_curated(purchases.occasions(prior), zones, OCCASIONS)
    occasions = readers.read_curated(spark, zones, OCCASIONS)
    writers.write_curated(purchases.pair_totals(occasions), zones, TOTALS)

    pairs = readers.read_curated(spark, zones, TOTALS)
    write_feature_tables(zones, pairs, purchases.early_purchases(occasions))


def write_feature_tables(zones: Zones, pairs: DataFrame, early: DataFrame) -> None:
    """From stored pair totals and the early purchases per product."""
    writers.write_curated(purchases.user_product_features(pairs), zones, "up_features")
    writers.write_curated(purchases.user_features(pairs), zones, "user_features", sort_by="user_id")
    writers.write_curated(purchases.product_features_with(pairs, early), zones, "product_features")


def write_ml_dataset(spark: SparkSession, zones: Zones) -> None:
    orders = readers.read_clean(spark, zones, "orders")
    users = mlset.target_users(
        readers.read_curated(spark, zones, "user_features"), mlset.target_orders(orders)
    )
    named = mlset.product_side(
        readers.read_clean(spark, zones, "products"),
        readers.read_curated(spark, zones, "product_features"),
    )
    writers.write_curated(users, zones, USERS)
    writers.write_curated(named, zones, NAMED)
    compact = mlset.assemble(
        orders,
        readers.read_clean(spark, zones, "order_products"),
        readers.read_curated(spark, zones, "up_features"),
        readers.read_curated(spark, zones, USERS),
        readers.read_curated(spark, zones, NAMED),
    )
    writers.write_ml_split(compact, zones)


def _sized(spark: SparkSession, zones: Zones):
    return sized_shuffles(spark, zones.clean_table("orders"), zones.clean_table("order_products"))


def curate_features(spark: SparkSession, zones: Zones) -> None:
    """History and features from all clean rows. What `plans.history` knew of
    loads is forgotten, as the tables no longer follow from it."""
    tune(spark)
    files.delete(spark, zones.history_log())
    with _sized(spark, zones):
        write_features(spark, zones)


def curate_ml_dataset(spark: SparkSession, zones: Zones) -> None:
    tune(spark)
    with _sized(spark, zones):
        write_ml_dataset(spark, zones)


def curate_all(spark: SparkSession, zones: Zones) -> None:
    """All curated tables from all clean rows."""
    curate_features(spark, zones)
    curate_ml_dataset(spark, zones)
