"""The registered queries in DuckDB's SQL, written as plain joins, distinct
counts and windows over single rows."""

from __future__ import annotations

from basketflow import schemas
from basketflow.testbed.queries import COEFFICIENTS, INTERCEPT, ONE_USER


def r2(top: str, bottom: str) -> str:
    """Two-decimal ratio of whole numbers, halves away from zero."""
    a, b = f"CAST({top} AS HUGEINT)", f"CAST(NULLIF({bottom}, 0) AS HUGEINT)"
    return f"CAST(sign({a}) * ((200 * abs({a}) + {b}) // (2 * {b})) AS DOUBLE) / 100"


FIXTURE = """
fx_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
    CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
              > CASE WHEN o_custkey % 9 = 3 THEN 2 ELSE 1 END THEN 'prior'
         WHEN o_custkey % 2 = 0 THEN 'train' ELSE 'test' END AS eval_set,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
    dayofweek(o_orderdate) AS order_dow,
    o_orderkey % 24 AS order_hour_of_day,
    CAST(date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
         o_orderdate) AS DOUBLE) AS days_since_prior_order
  FROM orders),
fx_products AS (
  SELECT product_id, product_name, CAST(floor(sqrt(product_id)) AS BIGINT) AS aisle_id,
    CAST(floor(sqrt(product_id)) AS BIGINT) // 3 AS department_id
  FROM (SELECT p_partkey // 20 AS product_id, min(p_name) AS product_name FROM part GROUP BY 1)),
fx_aisles AS (SELECT DISTINCT aisle_id, 'aisle ' || aisle_id AS aisle FROM fx_products),
fx_departments AS (SELECT DISTINCT department_id, 'department ' || department_id AS department FROM fx_products),
fx_lines AS (
  SELECT l_orderkey AS order_id, l_partkey // 20 AS product_id,
    CAST(min(l_linenumber) AS BIGINT) AS add_to_cart_order
  FROM lineitem GROUP BY 1, 2),
fx_order_products AS (
  SELECT order_id, product_id, add_to_cart_order,
    CASE WHEN min(order_number) OVER (PARTITION BY user_id, product_id) < order_number
         THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS reordered
  FROM fx_lines JOIN fx_orders USING (order_id)
  JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR (order_id + product_id) % 29 = 0)
"""

DIRTY = """
tx_orders AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id,
    CASE WHEN order_id % 97 IN (3, 4) THEN 'abc' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN order_id % 97 = 6 THEN NULL ELSE eval_set END AS eval_set,
    CAST(order_number AS VARCHAR) AS order_number,
    CASE order_id % 97 WHEN 1 THEN '7' WHEN 4 THEN '9' ELSE CAST(order_dow AS VARCHAR) END AS order_dow,
    CASE WHEN order_id % 97 = 2 THEN '24' ELSE CAST(order_hour_of_day AS VARCHAR) END AS order_hour_of_day,
    coalesce(CASE WHEN order_id % 97 = 5 THEN NULL ELSE CAST(days_since_prior_order AS VARCHAR) END, '-1')
      AS days_since_prior_order
  FROM fx_orders),
tagged_orders AS (
  SELECT *, CASE
      WHEN TRY_CAST(order_id AS BIGINT) IS NULL THEN 'order_id'
      WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN 'user_id'
      WHEN eval_set IS NULL THEN 'eval_set'
      WHEN TRY_CAST(order_number AS BIGINT) IS NULL THEN 'order_number'
      WHEN TRY_CAST(order_dow AS BIGINT) IS NULL THEN 'order_dow'
      WHEN TRY_CAST(order_hour_of_day AS BIGINT) IS NULL THEN 'order_hour_of_day'
      WHEN TRY_CAST(days_since_prior_order AS DOUBLE) IS NULL THEN 'days_since_prior_order'
      WHEN TRY_CAST(order_dow AS BIGINT) NOT BETWEEN 0 AND 6 THEN 'order_dow'
      WHEN TRY_CAST(order_hour_of_day AS BIGINT) NOT BETWEEN 0 AND 23 THEN 'order_hour' END AS rule
  FROM tx_orders),
cl_orders AS (
  SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(user_id AS BIGINT) AS user_id, eval_set,
    TRY_CAST(order_number AS BIGINT) AS order_number, TRY_CAST(order_dow AS BIGINT) AS order_dow,
    TRY_CAST(order_hour_of_day AS BIGINT) AS order_hour_of_day,
    TRY_CAST(days_since_prior_order AS DOUBLE) AS days_since_prior_order
  FROM tagged_orders WHERE rule IS NULL),
tx_order_products AS (
  SELECT CASE WHEN order_id % 89 = 3 THEN '-1' ELSE CAST(order_id AS VARCHAR) END AS order_id,
    CASE WHEN order_id % 89 = 2 THEN '100000000' ELSE CAST(product_id AS VARCHAR) END AS product_id,
    CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order,
    CASE WHEN order_id % 89 = 1 THEN '2' ELSE CAST(reordered AS VARCHAR) END AS reordered
  FROM fx_order_products),
cl_order_products AS (
  SELECT CAST(order_id AS BIGINT) AS order_id, CAST(product_id AS BIGINT) AS product_id,
    CAST(add_to_cart_order AS BIGINT) AS add_to_cart_order, CAST(reordered AS BIGINT) AS reordered
  FROM tx_order_products WHERE reordered IN ('0', '1')),
cl_products AS (
  SELECT product_id, product_name,
    CASE WHEN product_id % 17 = 1 THEN 999999 ELSE aisle_id END AS aisle_id,
    CASE WHEN product_id % 17 = 2 THEN 999999 ELSE department_id END AS department_id
  FROM fx_products),
reject_orders AS (
  SELECT 'orders' AS "table", rule, order_id, user_id, eval_set, order_number, order_dow,
    order_hour_of_day, days_since_prior_order
  FROM tagged_orders WHERE rule IS NOT NULL),
reject_order_products AS (
  SELECT 'order_products' AS "table", 'reordered' AS rule, * FROM tx_order_products
  WHERE reordered NOT IN ('0', '1')),
orphan_aisle AS (SELECT p.* FROM cl_products p WHERE aisle_id NOT IN (SELECT aisle_id FROM fx_aisles)),
orphan_department AS (
  SELECT p.* FROM cl_products p WHERE department_id NOT IN (SELECT department_id FROM fx_departments)),
orphan_product AS (
  SELECT l.* FROM cl_order_products l WHERE product_id NOT IN (SELECT product_id FROM cl_products)),
orphan_order AS (
  SELECT l.* FROM cl_order_products l WHERE order_id NOT IN (SELECT order_id FROM cl_orders))
"""

# What the features read: the fixture tables, or the cleaned dirty ones.
PLAIN_INPUT = """
b_orders AS (SELECT * REPLACE (coalesce(days_since_prior_order, -1) AS days_since_prior_order) FROM fx_orders),
b_order_products AS (SELECT * FROM fx_order_products),
b_products AS (SELECT * FROM fx_products)
"""
CLEANED_INPUT = """
b_orders AS (SELECT * FROM cl_orders),
b_order_products AS (SELECT * FROM cl_order_products),
b_products AS (SELECT * FROM cl_products)
"""

FEATURES = f"""
prior AS (
  SELECT l.order_id, product_id, add_to_cart_order, reordered, user_id, eval_set, order_number, order_dow,
    order_hour_of_day, days_since_prior_order,
    CASE WHEN order_dow IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM b_order_products l JOIN b_orders o ON l.order_id = o.order_id WHERE eval_set = 'prior'),
users AS (
  SELECT user_id, max(order_number) AS user_orders, count(*) AS user_total_products,
    sum(days_since_prior_order) AS user_period, avg(days_since_prior_order) AS user_mean_days_since_prior,
    count(DISTINCT product_id) AS user_distinct_products,
    CAST(count(*) FILTER (reordered = 1) AS DOUBLE) / NULLIF(count(*) FILTER (order_number > 1), 0)
      AS user_reorder_ratio,
    {r2("sum(is_weekend)", "count(*)")} AS weekend_order_ratio,
    count(*) FILTER (reordered = 1) AS total_reorders,
    {r2("count(*)", "max(order_number)")} AS user_average_basket
  FROM prior GROUP BY user_id),
ups AS (
  SELECT user_id, product_id, count(*) AS up_orders, CAST(sum(reordered) AS BIGINT) AS up_reorders,
    min(order_number) AS up_first_order, max(order_number) AS up_last_order,
    {r2("sum(add_to_cart_order)", "count(*)")} AS up_avg_add_to_cart_order,
    {r2("sum(days_since_prior_order)", "count(*)")} AS up_avg_time_since_last_order
  FROM prior GROUP BY user_id, product_id),
sequence AS (
  SELECT *, rank() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS product_seq_time
  FROM prior),
prods AS (
  SELECT *, {r2("prod_second_orders", "prod_first_orders")} AS prod_reorder_probability,
    {r2("prod_first_orders + prod_reorders", "prod_first_orders")} AS prod_reorder_times
  FROM (
    SELECT product_id, count(*) AS prod_orders, CAST(sum(reordered) AS BIGINT) AS prod_reorders,
      count(*) FILTER (product_seq_time = 1) AS prod_first_orders,
      count(*) FILTER (product_seq_time = 2) AS prod_second_orders,
      {r2("sum(add_to_cart_order)", "count(*)")} AS prod_avg_cart_position,
      {r2("sum(reordered)", "count(*)")} AS prod_reorder_rate
    FROM sequence GROUP BY product_id)),
targets AS (SELECT user_id, order_id, eval_set FROM b_orders WHERE eval_set <> 'prior'),
labels_ AS (
  SELECT t.order_id, t.user_id, t.eval_set, l.product_id, l.reordered
  FROM targets t JOIN b_order_products l ON t.order_id = l.order_id),
ml_users AS (SELECT u.* EXCLUDE (total_reorders) FROM users u JOIN targets USING (user_id)),
with_up AS (
  SELECT l.*, coalesce(up_orders, 0) AS up_orders, coalesce(up_reorders, 0) AS up_reorders,
    coalesce(up_first_order, 0) AS up_first_order, coalesce(up_last_order, 0) AS up_last_order,
    coalesce(up_avg_add_to_cart_order, 0) AS up_avg_add_to_cart_order,
    coalesce(up_avg_time_since_last_order, 0) AS up_avg_time_since_last_order
  FROM labels_ l LEFT JOIN ups ON l.user_id = ups.user_id AND l.product_id = ups.product_id),
with_product AS (
  SELECT l.product_id, l.order_id, coalesce(prod_orders, 0) AS prod_orders,
    coalesce(prod_avg_cart_position, 0) AS prod_avg_cart_position,
    coalesce(prod_reorder_rate, 0) AS prod_reorder_rate,
    coalesce(prod_reorder_probability, 0) AS prod_reorder_probability,
    coalesce(prod_reorder_times, 0) AS prod_reorder_times
  FROM labels_ l LEFT JOIN prods ON l.product_id = prods.product_id),
with_user AS (SELECT w.*, u.* EXCLUDE (user_id) FROM with_up w LEFT JOIN ml_users u ON w.user_id = u.user_id),
crossed AS (
  SELECT *, {r2("up_orders", "user_orders")} AS up_order_rate,
    user_orders - up_last_order AS up_orders_since_last_order,
    {r2("up_orders", "(user_orders - up_first_order + 1)")} AS up_order_rate_since_first_order
  FROM with_user),
final AS (
  SELECT {", ".join(schemas.ML_COLUMNS)} FROM crossed
  JOIN with_product USING (product_id, order_id) JOIN b_products USING (product_id)),
predictions AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS product_id,
    CASE WHEN product_id % 13 <> 0 THEN CAST((user_id * 31 + product_id * 17) % 100 AS DOUBLE) / 100 END
      AS predicted_probability
  FROM labels_ WHERE eval_set = 'test'),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY coalesce(predicted_probability, 0) DESC, product_id) AS position
  FROM predictions)
"""


def _with(select: str, cleaned: bool = False) -> str:
    source = CLEANED_INPUT if cleaned else PLAIN_INPUT
    return f"WITH {FIXTURE}, {DIRTY}, {source}, {FEATURES} {select}"


_LINEAR = " + ".join(f"{weight} * coalesce({name}, 0)" for name, weight in COEFFICIENTS.items())
_LABEL_FEATURES = ", ".join(f"f.{name}" for name in schemas.ML_COLUMNS[4:])

def _index(name: str) -> str:
    return f"""idx_{name} AS (
  SELECT {name}, row_number() OVER (ORDER BY n DESC, CAST({name} AS VARCHAR)) - 1 AS i, count(*) OVER () AS c
  FROM (SELECT {name}, count(*) AS n FROM prior JOIN b_products USING (product_id) GROUP BY {name}))"""


def _bits(name: str) -> str:
    """A one-hot vector as text; the last index is all zeros."""
    return (
        f"CASE WHEN {name}.i < {name}.c - 1 THEN repeat('0', CAST({name}.i AS INTEGER)) || '1' || "
        f"repeat('0', CAST({name}.c - 2 - {name}.i AS INTEGER)) ELSE repeat('0', CAST({name}.c - 1 AS INTEGER)) END"
    )


ONE_HOT = f"""WITH {FIXTURE}, {DIRTY}, {PLAIN_INPUT}, {FEATURES},
{_index("aisle_id")}, {_index("department_id")}
SELECT f.product_id, CAST(a.i AS DOUBLE) AS aisle_id_index, CAST(d.i AS DOUBLE) AS department_id_index,
  {_bits("a")} AS aisle_id_encoded, {_bits("d")} AS department_id_encoded,
  a.c - 1 AS aisle_id_size, d.c - 1 AS department_id_size
FROM prods f JOIN b_products p USING (product_id)
JOIN idx_aisle_id a ON p.aisle_id = a.aisle_id JOIN idx_department_id d ON p.department_id = d.department_id"""

ORACLE: dict[str, str] = {
    "clean_orders_kept": _with("SELECT * FROM cl_orders"),
    "clean_orders_rejects": _with("SELECT * FROM reject_orders"),
    "clean_order_products_kept": _with("SELECT * FROM cl_order_products"),
    "clean_order_products_rejects": _with("SELECT * FROM reject_order_products"),
    "quality_report": _with(
        """SELECT "table", rule, count(*) AS bad_rows FROM (
          SELECT "table", rule FROM reject_orders
          UNION ALL SELECT "table", rule FROM reject_order_products
          UNION ALL SELECT 'products', 'orphan_aisle' FROM orphan_aisle
          UNION ALL SELECT 'products', 'orphan_department' FROM orphan_department
          UNION ALL SELECT 'order_products', 'orphan_product' FROM orphan_product
          UNION ALL SELECT 'order_products', 'orphan_order' FROM orphan_order) GROUP BY 1, 2"""
    ),
    "orphans_aisle": _with("SELECT * FROM orphan_aisle"),
    "orphans_department": _with("SELECT * FROM orphan_department"),
    "orphans_product": _with("SELECT * FROM orphan_product"),
    "orphans_order": _with("SELECT * FROM orphan_order"),
    "order_products_prior": _with("SELECT * FROM prior"),
    "user_features": _with("SELECT * FROM users"),
    "user_features_in_order": _with(
        "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS position FROM users"
    ),
    "jobs_by_arguments": _with("SELECT * FROM final WHERE eval_set = 'test'", cleaned=True),
    "user_product_features": _with("SELECT * FROM ups"),
    "purchase_sequence": _with("SELECT user_id, product_id, order_number, product_seq_time FROM sequence"),
    "product_features": _with("SELECT * FROM prods"),
    "product_onehot": ONE_HOT,
    "target_orders": _with("SELECT * FROM targets"),
    "ml_labels": _with("SELECT * FROM labels_"),
    "ml_user_restricted": _with("SELECT * FROM ml_users"),
    "ml_attach_up": _with("SELECT * FROM with_up"),
    "ml_attach_product": _with("SELECT * FROM with_product"),
    "ml_attach_user": _with("SELECT * FROM with_user"),
    "ml_cross_features": _with("SELECT * FROM crossed"),
    "ml_training_data": _with("SELECT * FROM final WHERE eval_set = 'train'"),
    "ml_test_data": _with("SELECT * FROM final WHERE eval_set = 'test'"),
    "labels_with_features": _with(
        f"""SELECT l.user_id, l.product_id, l.eval_set, l.reordered, {_LABEL_FEATURES}
        FROM labels_ l LEFT JOIN final f ON l.user_id = f.user_id AND l.product_id = f.product_id"""
    ),
    "jobs_training_data": _with("SELECT * FROM final WHERE eval_set = 'train'", cleaned=True),
    "top3_all_users": _with(
        "SELECT user_id, product_id, predicted_probability, CAST(position AS INTEGER) AS position "
        "FROM ranked WHERE position <= 3"
    ),
    "top3_one_user": _with(
        "SELECT user_id, product_id, predicted_probability, CAST(position AS INTEGER) AS position "
        f"FROM ranked WHERE position <= 3 AND user_id = '{ONE_USER}'"
    ),
    "predictions_upsert": _with(
        """SELECT user_id, product_id,
          CASE WHEN CAST(product_id AS BIGINT) % 2 = 0 THEN predicted_probability + CAST(0.001 AS DOUBLE)
               ELSE predicted_probability END AS predicted_probability
        FROM predictions"""
    ),
    "latest_artifact": """
        SELECT 'output/job-' || event_id || '/output/model.tar.gz' AS key, ts AS last_modified
        FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, key LIMIT 1""",
    "notifications_valid": """
        SELECT event_id, reason IS NULL AS valid, reason FROM (
          SELECT event_id, CASE
            WHEN event_type = 'error' THEN 'records'
            WHEN event_type = 'view' THEN 'event'
            WHEN event_type = 'signup' THEN 'prefix'
            WHEN event_id % 10 = 0 THEN 'source' END AS reason
          FROM events)""",
    "train_and_score": _with(
        """SELECT eval_set, count(*) AS rows, count(DISTINCT (user_id, product_id)) AS pairs, count(*) AS in_range,
          true AS beats_base_rate, true AS near_label_rate
        FROM final GROUP BY eval_set"""
    ),
    "score_fixed_model": _with(
        f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS product_id,
          round(1 / (1 + exp(-({INTERCEPT} + {_LINEAR}))), 6) AS predicted_probability
        FROM final WHERE eval_set = 'test'"""
    ),
    "quarantine_rows": _with('SELECT * EXCLUDE ("table") FROM reject_order_products'),
    "repeated_lines": _with(
        """SELECT order_id, product_id, count(*) AS listed FROM fx_order_products
        GROUP BY order_id, product_id HAVING count(*) > 1"""
    ),
    "notified_prefix": _with("SELECT * FROM cl_order_products"),
    "notified_replaced_file": _with("SELECT * FROM cl_order_products"),
    "notified_training_data": _with("SELECT * FROM final WHERE eval_set = 'train'", cleaned=True),
    "incremental_features": _with("SELECT * FROM ups"),
    "incremental_history": _with("SELECT * FROM prior", cleaned=True),
    "incremental_users": _with("SELECT * FROM users", cleaned=True),
    "incremental_pairs": _with("SELECT * FROM ups", cleaned=True),
    "incremental_products": _with("SELECT * FROM prods", cleaned=True),
    "incremental_curated": _with("SELECT * FROM final WHERE eval_set = 'train'", cleaned=True),
    "catalog_tables": _with(
        """SELECT eval_set, count(*) AS rows, count(DISTINCT user_id) AS users,
          CAST(sum(p.prod_orders) AS BIGINT) AS product_lines
        FROM final JOIN prods p USING (product_id) GROUP BY eval_set""",
        cleaned=True,
    ),
    "sql_job": _with(
        """SELECT u.user_orders, count(DISTINCT u.user_id) AS users, CAST(sum(f.up_orders) AS BIGINT) AS lines,
          max(p.prod_orders) AS most_sold
        FROM users u JOIN ups f USING (user_id) JOIN prods p USING (product_id) GROUP BY u.user_orders""",
        cleaned=True,
    ),
    "incremental_clean": _with("SELECT * FROM cl_orders"),
    "notified_clean": _with("SELECT * FROM cl_order_products"),
    "catalog_sql": _with(
        """SELECT department, count(*) AS products, CAST(sum(prod_orders) AS BIGINT) AS lines,
          max(prod_reorder_rate) AS best_reorder_rate
        FROM prods JOIN b_products USING (product_id) JOIN fx_departments USING (department_id)
        GROUP BY department"""
    ),
}
