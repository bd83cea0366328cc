"""Features on hand-made histories, and against plain row-by-row code."""

import random
from collections import defaultdict
from types import SimpleNamespace

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketflow.functions.copies import CHUNK, repeat_rows
from basketflow.operators import encode, purchases
from basketflow.testbed import queries

PRIOR = "user_id bigint, product_id bigint, order_number bigint, add_to_cart_order bigint, reordered bigint, days_since_prior_order double, is_weekend int"


def prior(spark, rows):
    """rows: (user, product, order number[, cart position, reordered, gap, weekend])"""
    filled = [tuple(row) + (1, 0, 1.0, 0)[len(row) - 3 :] for row in rows]
    return spark.createDataFrame(filled, PRIOR)


def test_prior_lines_join_filter_and_flag(spark):
    from basketflow import schemas

    orders = spark.createDataFrame(
        [(1, 5, "prior", 1, 0, 8, -1.0), (2, 5, "prior", 2, 3, 8, 4.0), (3, 5, "train", 3, 6, 8, 2.0)],
        schemas.typed_schema("orders"),
    )
    lines = spark.createDataFrame(
        [(1, 7, 1, 0), (2, 7, 1, 1), (3, 7, 1, 1), (99, 7, 1, 1)], schemas.typed_schema("order_products")
    )
    got = purchases.prior_lines(lines, orders)
    assert got.columns == (
        "order_id product_id add_to_cart_order reordered user_id eval_set order_number order_dow "
        "order_hour_of_day days_since_prior_order is_weekend"
    ).split()
    assert sorted((r.order_id, r.is_weekend) for r in got.collect()) == [(1, 1), (2, 0)]


def test_user_features(spark):
    rows = [(1, 10, 1, 1, 0, -1.0, 1), (1, 11, 1, 2, 0, -1.0, 1), (1, 10, 2, 1, 1, 6.0, 0)]
    row = purchases.user_features(purchases.pair_totals(purchases.occasions(prior(spark, rows)))).first()
    assert row.asDict() == {
        "user_id": 1,
        "user_orders": 2,
        "user_total_products": 3,
        "user_period": 4.0,
        "user_mean_days_since_prior": 4.0 / 3,
        "user_distinct_products": 2,
        "user_reorder_ratio": 1.0,
        "weekend_order_ratio": 0.67,
        "total_reorders": 1,
        "user_average_basket": 1.5,
    }


def test_single_order_user_has_no_reorder_ratio(spark):
    row = purchases.user_features(purchases.pair_totals(purchases.occasions(prior(spark, [(1, 10, 1)])))).first()
    assert row.user_reorder_ratio is None


def test_pair_features_round_halves_up(spark):
    rows = [(1, 10, n, position) for n, position in enumerate([1] * 199 + [2], 1)]
    row = purchases.user_product_features(purchases.pair_totals(purchases.occasions(prior(spark, rows)))).first()
    assert (row.up_orders, row.up_first_order, row.up_last_order) == (200, 1, 200)
    assert row.up_avg_add_to_cart_order == 1.01


def test_ties_for_first_leave_nobody_second(spark):
    rows = [(1, 10, 1), (1, 10, 1), (1, 10, 2), (2, 10, 4), (2, 10, 6), (2, 10, 6), (3, 10, 1)]
    history = prior(spark, rows)
    occasions = purchases.occasions(history)
    row = purchases.product_features(purchases.pair_totals(occasions), occasions).first()
    assert (row.prod_first_orders, row.prod_second_orders) == (4, 2)
    assert row.prod_reorder_probability == 0.5


def ranks(rows):
    groups = defaultdict(list)
    for user, product, number in rows:
        groups[user, product].append(number)
    return sorted(
        (user, product, number, 1 + sum(other < number for other in numbers))
        for (user, product), numbers in groups.items()
        for number in numbers
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.integers(1, 2), st.integers(1, 2), st.integers(1, 9)), min_size=1, max_size=40),
    width=st.sampled_from([1, 3, 1 << 20]),
)
def test_sequence_matches_brute_force(spark, rows, width):
    history = prior(spark, rows)
    got = purchases.purchase_sequence(purchases.occasions(history), slice_orders=width)
    expected = ranks(rows)
    assert sorted(tuple(r) for r in got.collect()) == expected
    counts = purchases.early_purchases(purchases.occasions(history))
    assert {r.product_id: (r.prod_first_orders, r.prod_second_orders) for r in counts.collect()} == {
        product: tuple(sum(p == product and rank == n for _, p, _, rank in expected) for n in (1, 2))
        for product in {row[1] for row in rows}
    }


def test_rollups_agree_with_each_other(spark):
    dice = random.Random(3)
    rows = [(dice.randint(1, 9), dice.randint(1, 5), dice.randint(1, 6)) for _ in range(400)]
    history = prior(spark, rows)
    occasions = purchases.occasions(history)
    pairs = purchases.pair_totals(occasions)
    up = purchases.user_product_features(pairs).collect()
    per_user, per_product = defaultdict(int), defaultdict(int)
    for row in up:
        per_user[row.user_id] += row.up_orders
        per_product[row.product_id] += row.up_orders
    users = purchases.user_features(pairs).collect()
    products = purchases.product_features(pairs, occasions).collect()
    assert {r.user_id: r.user_total_products for r in users} == per_user
    assert {r.product_id: r.prod_orders for r in products} == per_product


def test_repeat_rows_beyond_one_chunk(spark):
    counts = {1: 1, 2: 0, 3: CHUNK, 4: CHUNK + 1, 5: 3 * CHUNK - 1}
    rows = spark.createDataFrame(list(counts.items()), "id int, copies bigint")
    got = repeat_rows(rows)
    assert got.columns == ["id"]
    assert {r.id: r["count"] for r in got.groupBy("id").count().collect()} == {
        key: n for key, n in counts.items() if n
    }


def test_one_hot_vectors_hold_their_index(spark, conf):
    """Labels by lines sold, over several ranges; the last has no place."""
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    fields = "product_id long, product_name string, aisle_id long, department_id long"
    products = spark.createDataFrame([(i, "p", i % 7, i % 3) for i in range(40)], fields)
    features = spark.createDataFrame([(i, i) for i in range(1, 40)] + [(99, 5)], "product_id long, prod_orders long")
    sold = {}
    for i in range(1, 40):
        sold[i % 7] = sold.get(i % 7, 0) + i
    place = {label: n for n, label in enumerate(sorted(sold, key=lambda label: (-sold[label], str(label))))}
    rows = {r.product_id: r for r in encode.product_onehot(products, features).collect()}
    assert len(rows) == 40 and rows[99].aisle_id_index is None
    for i in range(1, 40):
        at, vector = place[i % 7], rows[i].aisle_id_encoded
        assert (rows[i].aisle_id_index, rows[i].aisle_id_size, vector.size) == (at, 6, 6)
        assert list(vector.indices) == ([at] if at < 6 else [])


def test_one_hot_query_holds_the_whole_vectors(spark):
    fields = "product_id long, product_name string, aisle_id long, department_id long"
    products = spark.createDataFrame([(i, "p", i % 3, i % 2) for i in range(6)], fields)
    features = spark.createDataFrame([(i, 10 - i) for i in range(6)], "product_id long, prod_orders long")
    rows = queries.product_onehot(SimpleNamespace(products=products, product_features=features)).collect()
    # Lines sold by aisle: 0 has 17, 1 has 15, 2 has 13; by department: 0 has 24, 1 has 21.
    found = {r.product_id: (r.aisle_id_encoded, r.aisle_id_size, r.department_id_encoded) for r in rows}
    aisles = {0: "10", 1: "01", 2: "00"}
    assert found == {i: (aisles[i % 3], 2, "10"[i % 2]) for i in range(6)}
    none = SimpleNamespace(products=products, product_features=features.limit(0))
    assert queries.product_onehot(none).collect() == []
