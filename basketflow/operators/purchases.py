"""Purchase history and the features drawn from it.

History is aggregated once, to sums per occasion: (user, product, order
number). A user or product with a large share of all rows reaches it as partial
sums from each task. Pair totals, early purchases and the purchase sequence are
drawn from the occasions, and the features roll up the pair totals.

Fixed values: the column names of the three feature tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.copies import repeat_rows
from basketflow.functions.ratios import count_if, ratio, ratio2

PAIR = ["user_id", "product_id"]
ONLY = "only"
SLICE = 1 << 20


def prior_lines(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of past orders with their order's columns and a weekend flag."""
    weekend = F.coalesce(F.col("order_dow").isin(0, 6), F.lit(False)).cast("int")
    past = orders.filter(F.col("eval_set") == "prior").withColumn("is_weekend", weekend)
    return order_products.join(past, "order_id")


SUMS = [
    "lines", "reorders", "reordered_known", "reordered_lines", "cart_sum", "cart_known",
    "gap_sum", "gap_known", "weekend_lines",
]


def occasions(prior: DataFrame) -> DataFrame:
    """Sums per (user, product, order number), the one pass over history."""
    return prior.groupBy(*PAIR, "order_number").agg(
        F.count("*").alias("lines"),
        F.sum("reordered").alias("reorders"),
        F.count("reordered").alias("reordered_known"),
        count_if(F.col("reordered") == 1).alias("reordered_lines"),
        F.sum("add_to_cart_order").alias("cart_sum"),
        F.count("add_to_cart_order").alias("cart_known"),
        F.sum("days_since_prior_order").alias("gap_sum"),
        F.count("days_since_prior_order").alias("gap_known"),
        F.sum("is_weekend").alias("weekend_lines"),
    )


def each_line(prior: DataFrame) -> DataFrame:
    """Every line as an occasion of its own, for sums that need no others."""

    def known(name: str) -> Column:
        return F.col(name).isNotNull().cast("bigint")

    return prior.select(
        *PAIR,
        "order_number",
        F.lit(1).cast("bigint").alias("lines"),
        F.col("reordered").alias("reorders"),
        known("reordered").alias("reordered_known"),
        F.coalesce(F.col("reordered") == 1, F.lit(False)).cast("bigint").alias("reordered_lines"),
        F.col("add_to_cart_order").alias("cart_sum"),
        known("add_to_cart_order").alias("cart_known"),
        F.col("days_since_prior_order").alias("gap_sum"),
        known("days_since_prior_order").alias("gap_known"),
        F.col("is_weekend").alias("weekend_lines"),
    )


def pair_totals(per_occasion: DataFrame) -> DataFrame:
    """Sums per (user, product) from which every average can be rebuilt."""
    later = F.sum(F.when(F.col("order_number") > 1, F.col("lines")).otherwise(0))
    return per_occasion.groupBy(PAIR).agg(
        F.min("order_number").alias("first_order"),
        F.max("order_number").alias("last_order"),
        later.alias("later_lines"),
        *(F.sum(name).alias(name) for name in SUMS),
    )


def merge_totals(parts: DataFrame) -> DataFrame:
    """Pair totals of parts of history as those of the whole."""
    return parts.groupBy(PAIR).agg(
        F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"),
        *(F.sum(name).alias(name) for name in ["later_lines", *SUMS]),
    )


def user_product_features(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        *PAIR,
        F.col("lines").alias("up_orders"),
        F.col("reorders").alias("up_reorders"),
        F.col("first_order").alias("up_first_order"),
        F.col("last_order").alias("up_last_order"),
        ratio2("cart_sum", "cart_known").alias("up_avg_add_to_cart_order"),
        ratio2("gap_sum", "gap_known").alias("up_avg_time_since_last_order"),
    )


def user_features(pairs: DataFrame) -> DataFrame:
    """One row per user. Gaps and weekends weigh each order by its lines, and
    distinct products are the user's pairs, so no distinct count is needed."""
    totals = pairs.groupBy("user_id").agg(
        F.max("last_order").alias("user_orders"),
        F.sum("lines").alias("user_total_products"),
        F.sum("gap_sum").alias("user_period"),
        F.sum("gap_known").alias("gap_known"),
        F.count("product_id").alias("user_distinct_products"),
        F.sum("reordered_lines").alias("total_reorders"),
        F.sum("later_lines").alias("later_lines"),
        F.sum("weekend_lines").alias("weekend_lines"),
    )
    return totals.select(
        "user_id",
        "user_orders",
        "user_total_products",
        "user_period",
        ratio("user_period", "gap_known").alias("user_mean_days_since_prior"),
        "user_distinct_products",
        ratio("total_reorders", "later_lines").alias("user_reorder_ratio"),
        ratio2("weekend_lines", "user_total_products").alias("weekend_order_ratio"),
        "total_reorders",
        ratio2("user_total_products", "user_orders").alias("user_average_basket"),
    )


def purchase_sequence(per_occasion: DataFrame, slice_orders: int = SLICE) -> DataFrame:
    """Each line with how-manieth purchase of the product by the user it is;
    lines of the same order number share a rank and push later ranks on.

    A rank is one more than the lines before it. These are counted per slice of
    order numbers and then within a slice, so that even a pair with a large
    share of all rows is ranked by many tasks.
    """
    sliced = per_occasion.select(
        *PAIR, "order_number", "lines", F.expr(f"order_number DIV {slice_orders}").alias("_slice")
    )
    earlier_slices = (
        sliced.groupBy(*PAIR, "_slice")
        .agg(F.sum("lines").alias("_lines"))
        .withColumn(
            "_earlier",
            F.sum("_lines").over(
                Window.partitionBy(PAIR).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .drop("_lines")
    )
    in_slice = (
        Window.partitionBy(*PAIR, "_slice")
        .orderBy("order_number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    none = F.lit(0)
    ranked = (
        sliced.withColumn("_within", F.sum("lines").over(in_slice))
        .join(earlier_slices, [*PAIR, "_slice"])
        .select(
            *PAIR,
            "order_number",
            (1 + F.coalesce("_earlier", none) + F.coalesce("_within", none)).alias("product_seq_time"),
            "lines",
        )
    )
    return repeat_rows(ranked, "lines")


def _placed(per_occasion: DataFrame) -> DataFrame:
    """The occasions of each pair's two lowest order numbers, with their place.
    The filter on row_number lets Spark drop the others before the shuffle, so
    no task sees the whole history of a hot pair."""
    by_order = Window.partitionBy(PAIR).orderBy("order_number")
    return per_occasion.withColumn("place", F.row_number().over(by_order)).filter("place <= 2")


def several_orders(pairs: DataFrame) -> DataFrame:
    """(user, product) of the pairs with more than one order number."""
    return pairs.filter("first_order < last_order").select(PAIR)


def occasions_with_only(prior: DataFrame, pairs: DataFrame, several: DataFrame) -> DataFrame:
    """The lines per occasion; those of pairs with one order number follow from
    the totals and are marked as the `only` ones of their pair. Lines have
    users, products and order numbers, none of them null."""
    single = pairs.filter("first_order = last_order")
    single = single.select(*PAIR, F.col("first_order").alias("order_number"), "lines", F.lit(True).alias(ONLY))
    others = occasions(prior.join(several, PAIR, "left_semi")).select(*PAIR, "order_number", "lines")
    return single.unionByName(others.withColumn(ONLY, F.lit(False)))


def lowest_occasions(per_occasion: DataFrame) -> DataFrame:
    """(user, product, order number, lines) of the two lowest order numbers of
    each pair: all that early purchases follow from. Occasions marked as the
    `only` ones of their pair need no place."""
    columns = [*PAIR, "order_number", "lines"]
    if ONLY not in per_occasion.columns:
        return _placed(per_occasion).select(columns)
    placed = _placed(per_occasion.filter(~F.col(ONLY)))
    return placed.select(columns).unionByName(per_occasion.filter(ONLY).select(columns))


def merge_lowest(parts: DataFrame) -> DataFrame:
    """The lowest occasions of parts of history as those of the whole. A number
    among the two lowest of all is so in each part that has it, and its lines
    in several parts add up. A part has two rows of a pair at most, so they are
    dealt by pair at once, and nothing that follows by pair moves them again."""
    dealt = parts.repartition(*PAIR)
    return lowest_occasions(dealt.groupBy(*PAIR, "order_number").agg(F.sum("lines").alias("lines")))


def early_purchases(per_occasion: DataFrame) -> DataFrame:
    """Lines per product that were some user's first, and second, purchase.

    Only the two lowest order numbers of a pair matter, so `per_occasion` may
    be the lowest occasions alone. If the first order holds the product more
    than once, those lines tie for first and nobody is second.
    """
    lowest = _placed(per_occasion)
    per_pair = lowest.groupBy(PAIR).agg(
        F.sum(F.when(F.col("place") == 1, F.col("lines"))).alias("first"),
        F.sum(F.when(F.col("place") == 2, F.col("lines"))).alias("next"),
    )
    second = F.when(F.col("first") == 1, F.coalesce("next", F.lit(0))).otherwise(0)
    return per_pair.groupBy("product_id").agg(
        F.sum("first").alias("prod_first_orders"), F.sum(second).alias("prod_second_orders")
    )


def early_with_single(pairs: DataFrame, several: DataFrame) -> DataFrame:
    """As `early_purchases`, from the lowest occasions of `several_orders` alone:
    the lines of all other pairs are first purchases and nobody's second. Pairs
    and order numbers are not null."""
    once = pairs.filter("first_order = last_order").select(
        "product_id", F.col("lines").alias("prod_first_orders"), F.lit(0).cast("bigint").alias("prod_second_orders")
    )
    both = once.unionByName(early_purchases(several)).groupBy("product_id")
    return both.agg(*(F.sum(name).alias(name) for name in ("prod_first_orders", "prod_second_orders")))


def product_features(pairs: DataFrame, per_occasion: DataFrame) -> DataFrame:
    return product_features_with(pairs, early_purchases(per_occasion))


def product_features_with(pairs: DataFrame, early: DataFrame) -> DataFrame:
    """The features from pair totals and `early_purchases`."""
    totals = pairs.groupBy("product_id").agg(
        F.sum("lines").alias("prod_orders"),
        F.sum("reorders").alias("prod_reorders"),
        F.sum("reordered_known").alias("reordered_known"),
        F.sum("cart_sum").alias("cart_sum"),
        F.sum("cart_known").alias("cart_known"),
    )
    return totals.join(early, "product_id").select(
        "product_id",
        "prod_orders",
        "prod_reorders",
        "prod_first_orders",
        "prod_second_orders",
        ratio2("cart_sum", "cart_known").alias("prod_avg_cart_position"),
        ratio2("prod_reorders", "reordered_known").alias("prod_reorder_rate"),
        ratio2("prod_second_orders", "prod_first_orders").alias("prod_reorder_probability"),
        F.round(1 + ratio("prod_reorders", "prod_first_orders"), 2).alias("prod_reorder_times"),
    )
