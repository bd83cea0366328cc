"""The shape of the plans: what is pushed down, shuffled, and split."""

import os
import re

import pytest
from conftest import SMALL, final_plan
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.operators import mlset, orphans, purchases, serve
from basketflow.session import stored
from basketflow.testbed import mapping
from basketflow.testbed.queries import Basket

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
# A partition is skewed from 20 kB on, so that a small fixture can be skewed.
TOUCHY = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
    "spark.sql.shuffle.partitions": "16",
}


def shuffles(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", re.sub(r"#\d+L?", "", plan))


@pytest.fixture(scope="module")
def basket(spark):
    return Basket(spark, SMALL)


@pytest.fixture(scope="module")
def prior(spark, basket):
    return stored(basket.prior, "prior")


@pytest.fixture(scope="module")
def occasions(spark, prior):
    return stored(purchases.occasions(prior), "occasions")


def test_prior_filter_and_columns_reach_the_scan(basket):
    plan = basket.prior.select("user_id", "product_id")._jdf.queryExecution().toString()
    assert "EqualTo(eval_set,prior)" in plan
    assert "ReadSchema: struct<order_id:bigint,user_id:bigint,eval_set:string>" in plan
    assert "ReadSchema: struct<order_id:bigint,product_id:bigint>" in plan


def test_occasions_shuffle_history_once(prior):
    assert shuffles(final_plan(purchases.occasions(prior))) == ["user_id, product_id, order_number"]


def test_features_take_one_pass_over_the_tables(spark, basket):
    """Each table is scanned once, for the occasions; the rest reads those."""
    plan = final_plan(basket.occasions)
    assert len(re.findall("FileScan parquet", plan)) == 2
    kept = Basket(spark, SMALL).keep_pairs()
    for frame in (kept.product_features, purchases.purchase_sequence(kept.occasions)):
        scans = re.findall(r"FileScan parquet .*?Location: [^\[]*\[([^\]]*)\]", final_plan(frame))
        assert scans and all("occasions" in s or "pair-totals" in s for s in scans)


def test_user_rollup_counts_distinct_products_without_expanding(occasions):
    plan = final_plan(purchases.user_features(purchases.pair_totals(occasions)))
    assert sorted(shuffles(plan)) == ["user_id", "user_id, product_id"]
    assert "Expand" not in plan


def test_a_split_is_filtered_in_the_scan_and_not_rebalanced(spark):
    frame = Basket(spark, SMALL).keep_pairs().split("train")
    assert "EqualTo(eval_set,train)" in frame._jdf.queryExecution().toString()
    # Only the branch of rows with more copies than a chunk is rebalanced.
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("RebalancePartitions")[1:]:
        assert "16384" in line.split("Filter")[1][:400]


def test_merged_lowest_orders_are_shuffled_once(occasions):
    lowest = purchases.merge_lowest(purchases.lowest_occasions(occasions).localCheckpoint())
    assert shuffles(final_plan(purchases.early_purchases(lowest))) == ["product_id", "user_id, product_id"]


def test_sized_tasks_join_by_hash_and_write_less(spark, conf, tmp_path):
    from basketflow import session

    before = dict(zip(session.SIZED, ("0", "snappy")))
    conf({**NO_BROADCAST, **before})
    a, b = (stored(spark.range(size).repartition(4), f"side-{size}") for size in (1000, 2000))
    with session.sized_shuffles(spark, str(tmp_path)):
        assert "ShuffledHashJoin" in final_plan(a.join(b, "id"))
        a.write.parquet(f"{tmp_path}/written")
        assert all(".zstd." in name for name in os.listdir(f"{tmp_path}/written") if name.startswith("part-"))
    assert {key: spark.conf.get(key) for key in before} == before


def test_a_side_that_is_large_in_memory_is_not_joined_by_hash(spark, conf, tmp_path):
    """Two partitions of some 25 MB each, more than is merged for a task."""
    from basketflow import session

    conf({**NO_BROADCAST, "spark.sql.shuffle.partitions": "2"})
    wide = (spark.range(2_400_000).select(F.xxhash64("id").alias("id"), F.hash("id").alias(f"n{n}")) for n in (1, 2))
    a, b = (stored(side, "wide") for side in wide)
    with session.sized_shuffles(spark, str(tmp_path)):
        assert "ShuffledHashJoin" not in final_plan(a.join(b, "id").agg(F.sum("n1"), F.sum("n2")))


def test_lines_are_dealt_by_order_once(spark, basket):
    frame = mapping.order_products(spark, SMALL, basket.tables["orders"])
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", re.sub(r"#\d+L?", "", final_plan(frame)))
    assert sorted(set(dealt)) == ["order_id", "user_id, product_id"]


def test_targets_filter_lines_of_some_size_before_the_shuffle(spark, conf):
    """Lines of 64 MB and more are filtered without any setting."""
    conf(NO_BROADCAST)
    ids = F.xxhash64("id")
    lines = spark.range(9_000_000).select(ids.alias("order_id"), "id")
    lines = stored(lines.withColumns({"product_id": F.col("id"), "reordered": F.lit(0)}).drop("id"), "many-lines")
    orders = spark.range(1000).select(
        ids.alias("order_id"),
        F.col("id").alias("user_id"),
        F.when(F.col("id") < 10, "train").otherwise("prior").alias("eval_set"),
    )
    labels = mlset.labels(mlset.target_orders(mlset.split(stored(orders, "few-orders"), "train")), lines)
    assert "might_contain" in labels._jdf.queryExecution().optimizedPlan().toString()
    assert labels.count() == 10


def test_early_purchases_limit_before_the_shuffle(occasions):
    plan = final_plan(purchases.early_purchases(occasions))
    assert len(re.findall(r"WindowGroupLimit .* Partial", plan)) == 1


def test_top_k_limits_before_the_shuffle(basket):
    plan = final_plan(serve.top_k(basket.predictions))
    assert len(re.findall(r"WindowGroupLimit .* Partial", plan)) == 1


def test_newest_limits_before_the_shuffle(basket):
    plan = final_plan(serve.newest(basket.predictions))
    assert len(re.findall(r"WindowGroupLimit .* Partial", plan)) == 1


def test_a_small_batch_leaves_the_old_scores_unshuffled(spark, basket):
    old = stored(basket.predictions, "old")
    new = stored(basket.predictions.filter("product_id = '3'"), "new")
    plan = serve.upsert_predictions(old, new)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [coalesce(user_id" in plan or "BroadcastHashJoin [user_id" in plan
    assert len(shuffles(plan)) == 1  # the batch, for its rows


def test_lookup_filters_in_the_scan(spark, basket):
    table = stored(basket.predictions, "scores")
    plan = serve.lookup(table, "7")._jdf.queryExecution().toString()
    assert "EqualTo(user_id,7)" in plan


def test_nothing_is_a_nested_loop(basket):
    for df in (basket.split("train"), basket.product_features, basket.prior):
        plan = final_plan(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_big_dimension_is_not_broadcast(conf, basket):
    conf(NO_BROADCAST)
    products = schemas.REFERENCES[0]
    assert "Broadcast" not in final_plan(orphans.orphans(basket.tables, products))


def skewed(spark):
    """A third of all lines in one order, of all target lines by one user, and
    of all lines of one product."""
    n = 60_000
    orders = spark.range(n).selectExpr(
        "id AS order_id",
        "IF(id % 3 = 0, 0, id) AS user_id",
        "IF(id % 2 = 0, 'prior', 'train') AS eval_set",
        "id AS order_number",
        "id % 7 AS order_dow",
        "id % 24 AS order_hour_of_day",
        "1.0D AS days_since_prior_order",
    )
    lines = spark.range(2 * n).selectExpr(
        "IF(id % 3 = 0, 1, id % 60000) AS order_id",
        "IF(id % 3 = 1, 5, id) AS product_id",
        "id AS add_to_cart_order",
        "id % 2 AS reordered",
    )
    # Many files, as skewed partitions are split between map tasks.
    return stored(orders.repartition(16), "orders"), stored(lines.repartition(16), "lines")


def test_hot_orders_users_and_products_are_split(spark, conf):
    orders, lines = skewed(spark)
    conf(TOUCHY)
    assert "skew=true" in final_plan(purchases.prior_lines(lines, orders.replace("train", "prior", "eval_set")))
    assert "skew=true" in final_plan(mlset.labels(mlset.target_orders(orders), lines))

    label_rows = stored(mlset.labels(mlset.target_orders(orders), lines).repartition(16), "labels")
    labels_ = label_rows.selectExpr("*", "1L AS copies")
    users = stored(spark.range(60_000).selectExpr("id AS user_id", "id AS user_orders", "1L AS copies"), "users")
    assert "skew=true" in final_plan(mlset.attach_user(labels_, users))

    products = stored(spark.range(120_000).selectExpr("id AS product_id", "'x' AS product_name"), "products")
    assert "skew=true" in final_plan(labels_.join(products, "product_id"))


def test_compact_labels_still_split_a_hot_order(spark, conf):
    orders, lines = skewed(spark)
    conf(TOUCHY)
    compact = mlset.distinct_labels(mlset.labels(mlset.target_orders(orders), lines))
    assert "skew=true" in final_plan(compact)
    assert compact.selectExpr("sum(copies)").first()[0] == mlset.labels(mlset.target_orders(orders), lines).count()


def test_mapping_marks_reordered_lines_in_one_shuffle_of_them(spark, conf, tmp_path):
    conf(NO_BROADCAST)
    lines = [(order, part, order % 4 + 1) for order in range(60) for part in (order % 3 * 20, 40, None)]
    schema = "l_orderkey long, l_partkey long, l_linenumber int"
    spark.createDataFrame(lines * 2, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(order, order % 7, order // 14 + 1) for order in range(55)]
    numbered = stored(spark.createDataFrame(orders, "order_id long, user_id long, order_number long"), "numbered")
    frame = mapping.order_products(spark, str(tmp_path), numbered)
    assert shuffles(final_plan(frame)).count("user_id, product_id") == 1

    bought = {(order, part // 20, at) for order, part, at in lines if part is not None and order < 55}
    user, number = ({row[0]: row[at] for row in orders} for at in (1, 2))
    expected = []
    for order, product, at in bought:
        first = min(number[o] for o, p, _ in bought if p == product and user[o] == user[order])
        copies = 2 if (order + product) % mapping.LISTED_TWICE == 0 else 1
        expected += [(order, product, at, int(first < number[order]))] * copies
    assert sorted(map(tuple, frame.collect())) == sorted(expected)


def test_mapping_numbers_orders_like_one_window_per_user(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    by_date = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    expected = spark.read.parquet(f"{SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), F.row_number().over(by_date).alias("n")
    )
    got = mapping.orders(spark, SMALL).select("order_id", F.col("order_number").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_joins_by_order_move_neither_side_of_the_clean_tables(spark, conf, tmp_path):
    """Orphans, history and labels, over two loads of each table."""
    from basketflow import schemas
    from basketflow.sources import buckets, readers, writers
    from basketflow.sources.zones import Zones

    zones, tables = Zones.under(str(tmp_path)), mapping.tables(spark, SMALL)
    for load in (0, 1):
        for table in buckets.TABLES:
            part = tables[table].filter(f"order_id % 2 = {load}")
            writers.write_clean(part, zones, table, load, replace=not load)
    conf(NO_BROADCAST)
    orders, lines = (readers.read_clean(spark, zones, table) for table in buckets.TABLES)
    reference = next(r for r in schemas.REFERENCES if r.name == "order")
    plain = {table: tables[table] for table in buckets.TABLES}
    for make in (
        lambda t: orphans.orphans(t, reference),
        lambda t: purchases.prior_lines(t["order_products"], t["orders"]),
        lambda t: mlset.labels(mlset.target_orders(t["orders"]), t["order_products"]),
    ):
        joined = make({"orders": orders, "order_products": lines})
        plan = final_plan(joined)
        assert "Join" in plan and "Exchange" not in plan
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, make(plain).collect()))
    assert "Exchange" in final_plan(purchases.prior_lines(tables["order_products"], tables["orders"]))


def test_a_table_with_a_hot_order_is_not_bucketed(spark, tmp_path, monkeypatch):
    from basketflow.sources import buckets, readers, writers
    from basketflow.sources.zones import Zones

    monkeypatch.setattr(buckets, "FEW", 10)
    monkeypatch.setattr(buckets, "UNEVEN", 1.2)
    zones = Zones.under(str(tmp_path))
    _, lines = skewed(spark)
    writers.write_clean(lines, zones, "order_products")
    assert buckets.count(spark, zones, "order_products") is None
    assert readers.read_clean(spark, zones, "order_products").count() == lines.count()


def test_target_orders_filter_the_lines_before_the_shuffle(spark, conf):
    """The targets are too large to broadcast, and send a filter instead."""
    lines = stored(mapping.tables(spark, SMALL)["order_products"], "lines")
    orders = stored(mapping.tables(spark, SMALL)["orders"], "orders")

    def train():
        return mlset.labels(mlset.target_orders(mlset.split(orders, "train")), lines)

    expected = sorted(map(tuple, train().collect()))
    conf({**NO_BROADCAST, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"})
    frame = train()
    assert "might_contain" in final_plan(frame)
    assert sorted(map(tuple, frame.collect())) == expected
