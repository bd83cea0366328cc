"""Basket tables drawn from the supplied order and event tables.

Orders of a user are numbered by day first and then within the day, so that
numbering the orders of one very busy user is shared out over its days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.session import files_size, once, size_tasks, stored

# So many parts are one product, so that products come back often enough. Of N
# products there are about sqrt(N) aisles, and so many aisles are a department.
PARTS, DEPARTMENT = 20, 3
# One user in SECOND_TARGET has two target orders, and an order lists one
# product in LISTED_TWICE twice.
SECOND_TARGET, LISTED_TWICE = 9, 29


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("at"),
        F.to_date("o_orderdate").alias("day"),
    )
    user_days = Window.partitionBy("user_id").orderBy("day")
    days = (
        rows.groupBy("user_id", "day")
        .agg(F.count("*").alias("in_day"))
        .withColumns(
            {
                "before": F.coalesce(
                    F.sum("in_day").over(user_days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "all": F.sum("in_day").over(Window.partitionBy("user_id")),
                "previous_day": F.lag("day").over(user_days),
            }
        )
    )
    # A user's orders of one day are few in any data that has users; they are
    # the smallest group that numbering needs.
    place = F.row_number().over(Window.partitionBy("user_id", "day").orderBy("at", "order_id"))
    numbered = rows.withColumn("place", place).join(days, ["user_id", "day"])
    number = F.col("before") + F.col("place")
    gap = F.when(F.col("place") > 1, 0).otherwise(F.date_diff("day", "previous_day"))
    split = F.when(F.col("user_id") % 2 == 0, "train").otherwise("test")
    targets = F.when(F.col("user_id") % SECOND_TARGET == 3, 2).otherwise(1)
    return numbered.select(
        "order_id",
        "user_id",
        F.when(number > F.col("all") - targets, split).otherwise("prior").alias("eval_set"),
        number.alias("order_number"),
        (F.dayofweek("day") - 1).cast("bigint").alias("order_dow"),
        (F.col("order_id") % 24).alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = (
        _table(spark, sf_dir, "part")
        .groupBy(F.expr(f"p_partkey DIV {PARTS}").alias("product_id"))
        .agg(F.min("p_name").alias("product_name"))
    )
    with_aisle = named.withColumn("aisle_id", F.floor(F.sqrt("product_id")).cast("bigint"))
    return with_aisle.withColumn("department_id", F.expr(f"aisle_id DIV {DEPARTMENT}"))


def aisles(named: DataFrame) -> DataFrame:
    ids = named.select("aisle_id").distinct()
    return ids.withColumn("aisle", F.concat(F.lit("aisle "), F.col("aisle_id")))


def departments(named: DataFrame) -> DataFrame:
    ids = named.select("department_id").distinct()
    return ids.withColumn("department", F.concat(F.lit("department "), F.col("department_id")))


def order_products(spark: SparkSession, sf_dir: str, numbered: DataFrame) -> DataFrame:
    """Lines of the mapped orders, `numbered`. They are dealt by order once, for
    their grouping and the join, which is a merge, as lines in the order of
    their orders take less room in all that follows. Lines of a user
    and product are no more than the user's orders, so the earliest of them is
    found where they lie side by side, and the lines move once for it."""
    lines = (
        _table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("order_id"), F.expr(f"l_partkey DIV {PARTS}").alias("product_id"), "l_linenumber"
        )
        .filter("order_id IS NOT NULL AND product_id IS NOT NULL")
        .repartition("order_id")
        .groupBy("order_id", "product_id")
        .agg(F.min("l_linenumber").cast("bigint").alias("add_to_cart_order"))
        .join(numbered.select("order_id", "user_id", "order_number").hint("merge"), "order_id")
    )
    first = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
    again = (first < F.col("order_number")).cast("bigint")
    twice = (F.col("order_id") + F.col("product_id")) % LISTED_TWICE == 0
    copy = F.explode(F.sequence(F.lit(0), F.when(twice, 1).otherwise(0)))
    marked = lines.withColumn("reordered", again)
    return marked.select("order_id", "product_id", "add_to_cart_order", "reordered", copy.alias("copy")).drop("copy")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The basket tables as Parquet, which is how the operators find them in a
    clean zone. They are written once per application and data folder; tasks are
    sized for them in every session that asks."""
    size_tasks(spark, sum(files_size(_table(spark, sf_dir, name)) for name in ("orders", "part", "lineitem")))

    def write() -> dict[str, DataFrame]:
        numbered = stored(orders(spark, sf_dir), "orders")
        named = stored(products(spark, sf_dir), "products")
        return {
            "aisles": stored(aisles(named), "aisles"),
            "departments": stored(departments(named), "departments"),
            "products": named,
            "orders": numbered,
            "order_products": stored(order_products(spark, sf_dir, numbered), "order_products"),
        }

    return once(spark, ("tables", sf_dir), write)


def dirty(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A basket table as raw text, with some rows spoilt by id."""
    typed = tables(spark, sf_dir)[table]
    text = typed.select([F.col(name).cast("string") for name in schemas.columns(table)])

    def spoil(key: str, modulus: int, changes: dict[str, dict[int, str | None]]) -> DataFrame:
        """changes: column -> {key % modulus: the text that replaces it}"""
        slot = F.col(key).cast("bigint") % modulus
        replaced = {}
        for column, values in changes.items():
            cell = F.col(column)
            for at, value in values.items():
                cell = F.when(slot == at, F.lit(value)).otherwise(cell)
            replaced[column] = cell
        return text.withColumns(replaced)

    if table == "orders":
        return spoil(
            "order_id",
            97,
            {
                "order_dow": {1: "7", 4: "9"},
                "order_hour_of_day": {2: "24"},
                "user_id": {3: "abc", 4: "abc"},
                "days_since_prior_order": {5: None},
                "eval_set": {6: None},
            },
        )
    if table == "order_products":
        return spoil(
            "order_id", 89, {"reordered": {1: "2"}, "product_id": {2: "100000000"}, "order_id": {3: "-1"}}
        )
    if table == "products":
        return spoil("product_id", 17, {"aisle_id": {1: "999999"}, "department_id": {2: "999999"}})
    return text


def predictions(test_labels: DataFrame) -> DataFrame:
    """A score per (user, product) of the test labels, some missing, many tied."""
    score = ((F.col("user_id") * 31 + F.col("product_id") * 17) % 100) / F.lit(100.0)
    return test_labels.select(
        F.col("user_id").cast("string"),
        F.col("product_id").cast("string"),
        F.when(F.col("product_id") % 13 != 0, score).alias("predicted_probability"),
    ).distinct()


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.concat(F.lit("output/job-"), F.col("event_id"))
    name = F.when(F.col("event_type") == "purchase", "/output/model.tar.gz").otherwise("/logs.txt")
    return _table(spark, sf_dir, "events").select(
        F.concat(folder, name).alias("key"), F.col("ts").alias("last_modified")
    )


def notifications(spark: SparkSession, sf_dir: str, prefix: str = "data/") -> DataFrame:
    """(event_id, value): one JSON message per event."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "purchase", "ObjectRemoved:Delete")
        .when(kind == "view", "ObjectRestore:Post")
        .otherwise("ObjectCreated:Put")
    )
    table = F.element_at(
        F.array([F.lit(t) for t in sorted(schemas.DECLARED)]), (F.col("event_id") % 5 + 1).cast("int")
    )
    folder = F.when(kind == "signup", "logs/").otherwise(prefix)

    def record(source: str):
        return F.struct(
            F.lit(source).alias("eventSource"),
            name.alias("eventName"),
            F.struct(
                F.struct(F.lit("raw").alias("name")).alias("bucket"),
                F.struct(F.concat(folder, table, F.lit(".csv")).alias("key")).alias("object"),
            ).alias("s3"),
        )

    good, bad = record("aws:s3"), record("aws:sqs")
    records = (
        F.when(kind == "error", F.slice(F.array(good), 1, 0))
        .when(F.col("event_id") % 10 == 0, F.array(good, bad))
        .otherwise(F.array(good))
    )
    return _table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(records.alias("Records"))).alias("value")
    )
