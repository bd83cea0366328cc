"""One registered query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions.copies import repeat_rows
from basketflow.operators import (
    artifacts,
    encode,
    mlset,
    notifications,
    orphans,
    purchases,
    serve,
    validate,
)
from basketflow.plans import history, recommend
from basketflow.plans.cleaning import load_table
from basketflow.plans.curation import curate_all
from basketflow.plans.runner import main, run_all
from basketflow.session import once, scratch, stored, tune
from basketflow.sources import catalog, files, predictions, readers, writers
from basketflow.sources.readers import CSV
from basketflow.sources.zones import Zones
from basketflow.streaming.arrivals import on_notifications
from basketflow.streaming.incremental import incremental_clean
from basketflow.testbed import mapping

Query = Callable[[SparkSession, str], DataFrame]
ONE_USER = "7"


class Basket:
    """The clean tables of a data folder and what the operators make of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = mapping.tables(spark, sf_dir)
        self.orders = self.tables["orders"].fillna(-1.0, ["days_since_prior_order"])
        self.order_products = self.tables["order_products"]
        self.products = self.tables["products"]

    @cached_property
    def prior(self) -> DataFrame:
        return purchases.prior_lines(self.order_products, self.orders)

    @cached_property
    def occasions(self) -> DataFrame:
        return purchases.occasions(self.prior)

    @cached_property
    def pairs(self) -> DataFrame:
        return purchases.pair_totals(self.occasions)

    def keep_pairs(self) -> "Basket":
        """Store occasions and pair totals, for queries that use them several times."""
        self.occasions = stored(self.occasions, "occasions")
        self.pairs = stored(self.pairs, "pair-totals")
        return self

    @cached_property
    def up_features(self) -> DataFrame:
        return purchases.user_product_features(self.pairs)

    @cached_property
    def user_features(self) -> DataFrame:
        return purchases.user_features(self.pairs)

    @cached_property
    def product_features(self) -> DataFrame:
        return purchases.product_features(self.pairs, self.occasions)

    @cached_property
    def targets(self) -> DataFrame:
        return mlset.target_orders(self.orders)

    @cached_property
    def labels(self) -> DataFrame:
        return mlset.labels(self.targets, self.order_products)

    @cached_property
    def target_users(self) -> DataFrame:
        return mlset.target_users(self.user_features, self.targets)

    @cached_property
    def with_up(self) -> DataFrame:
        return mlset.attach_up(self.labels, self.up_features)

    @cached_property
    def with_user(self) -> DataFrame:
        """Compact: `copies` holds how often each row stands."""
        users = stored(self.target_users, "target-users")
        return mlset.attach_user(self.with_up.withColumn("copies", F.lit(1)), users)

    def ml_set(self, eval_set: str | None = None) -> DataFrame:
        """The compact ML set, or one split of it."""
        named = mlset.product_side(self.products, self.product_features)
        return mlset.assemble(
            mlset.split(self.orders, eval_set) if eval_set else self.orders,
            self.order_products,
            self.up_features,
            stored(self.target_users, "target-users"),
            stored(named, "named-products"),
        )

    def split(self, eval_set: str) -> DataFrame:
        return repeat_rows(self.ml_set(eval_set))

    @cached_property
    def predictions(self) -> DataFrame:
        return mapping.predictions(mlset.split(self.labels, "test"))


def over_basket(build: Callable[[Basket], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Basket(tune(spark), sf_dir))


def over_pairs(build: Callable[[Basket], DataFrame]) -> Query:
    return over_basket(lambda basket: build(basket.keep_pairs()))


def dirty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: mapping.dirty(spark, sf_dir, table) for table in schemas.DECLARED}


def kept(table: str) -> Query:
    return lambda spark, sf_dir: validate.clean(table, mapping.dirty(tune(spark), sf_dir, table))[0]


def rejected(table: str) -> Query:
    return lambda spark, sf_dir: validate.clean(table, mapping.dirty(tune(spark), sf_dir, table))[1]


def orphaned(name: str) -> Query:
    reference = next(r for r in schemas.REFERENCES if r.name == name)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        needed = {reference.child, reference.parent}
        tables = {
            table: validate.clean(table, mapping.dirty(spark, sf_dir, table))[0] for table in needed
        }
        return orphans.orphans(tables, reference)

    return query


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raw table is parsed once. Of the result, rejects need the rule and
    orphans the keys of the references."""
    good, bad = {}, {}
    for table, raw in dirty_tables(tune(spark), sf_dir).items():
        rows = stored(validate.tagged_keys(table, validate.tag(table, raw)), f"tagged-{table}")
        good[table] = rows.filter(F.col(validate.RULE).isNull()).drop(validate.RULE)
        bad[table] = rows.filter(F.col(validate.RULE).isNotNull()).select(F.lit(table).alias("table"), validate.RULE)
    return validate.quality_report(bad, orphans.all_orphans(good))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected order lines as the cleaning job wrote them."""
    zones = Zones.under(scratch(tune(spark), "quarantine"))
    write_raw(spark, sf_dir, zones, ["order_products"])
    load_table(readers.read_raw(spark, zones, "order_products"), zones, "order_products")
    return readers.read_rejects(spark, zones, "order_products")


def write_raw(spark: SparkSession, sf_dir: str, zones: Zones, names: list[str]) -> None:
    for table in names:
        raw = mapping.dirty(spark, sf_dir, table)
        raw.write.options(**CSV).csv(zones.raw_table(table))


def jobs_training_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs on raw CSV files; the training split as written."""
    zones = Zones.under(scratch(tune(spark), "jobs"))
    write_raw(spark, sf_dir, zones, list(schemas.DECLARED))
    run_all(spark, zones)
    return readers.read_ml_split(spark, zones, "train")


def jobs_by_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs by their command line, each zone given by itself; the test
    split as written."""
    root = scratch(tune(spark), "arguments")
    zones = Zones(*(f"{root}/{name}-zone" for name in ("raw", "clean", "curated", "consumption", "quarantine")), "in/")
    write_raw(spark, sf_dir, zones, list(schemas.DECLARED))
    between = ["--clean", zones.clean]
    main(["clean", "--raw", zones.raw, *between, "--quarantine", zones.quarantine, "--prefix", zones.prefix])
    main(["curate", *between, "--curated", zones.curated])
    return readers.read_ml_split(spark, zones, "test")


def user_features_in_order(basket: Basket) -> DataFrame:
    """The place of each user in the written table, file after file."""
    zones = Zones.under(scratch(basket.orders.sparkSession, "in-order"))
    writers.write_curated(basket.user_features, zones, "user_features", sort_by="user_id")
    rows = readers.read_curated(basket.orders.sparkSession, zones, "user_features").select(
        "user_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    sizes = rows.groupBy("file").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "file").select("user_id", (F.col("start") + F.col("row")).alias("position"))


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean orders after a file stream took the raw ones a file at a time."""
    root = scratch(tune(spark), "incremental")
    zones = Zones.under(root)
    raw = mapping.dirty(spark, sf_dir, "orders").repartition(3)
    raw.write.options(**CSV).csv(zones.raw_table("orders"))
    incremental_clean(spark, zones, "orders", f"{root}/checkpoint", max_files=1)
    return readers.read_clean(spark, zones, "orders")


def notified(spark: SparkSession, sf_dir: str, prefix: str = "data/", then=None) -> Zones:
    """Zones after a notification stream refreshed the clean tables."""
    root = scratch(tune(spark), "arrivals")
    zones = Zones.under(root, prefix)
    write_raw(spark, sf_dir, zones, list(schemas.DECLARED))
    mapping.notifications(spark, sf_dir, prefix).select("value").write.text(f"{root}/inbox")
    on_notifications(spark, zones, f"{root}/inbox", f"{root}/checkpoint", then=then)
    return zones


def notified_order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_clean(spark, notified(spark, sf_dir), "order_products")


def notified_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the raw tables, and the notified keys, in another folder."""
    return readers.read_clean(spark, notified(spark, sf_dir, "incoming/day/"), "order_products")


def notified_replaced_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean order lines after a notification that raw files changed: of
    four files by order, one was replaced, one removed, and one is new. They
    then hold all lines once, as at first one held too many and one too few."""
    root = scratch(tune(spark), "replaced")
    zones = Zones.under(root)
    raw = mapping.dirty(spark, sf_dir, "order_products")
    part = F.pmod(F.hash("order_id"), F.lit(4))

    def put(name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").options(**CSV).csv(f"{zones.raw_table('order_products')}/{name}")

    def notify(name: str, at: int) -> None:
        record = f"""{{"eventSource": "aws:s3", "eventName": "{name}",
            "s3": {{"bucket": {{"name": "raw"}}, "object": {{"key": "data/order_products.csv/x"}}}}}}"""
        message = f'{{"Records": [{" ".join(record.split())}]}}'
        spark.createDataFrame([(message,)], "value string").coalesce(1).write.text(f"{root}/inbox-{at}")
        on_notifications(spark, zones, f"{root}/inbox-{at}", f"{root}/checkpoint-{at}")

    put("kept", raw.filter(part == 0))
    put("replaced", raw.filter(part != 2))
    put("removed", raw.filter(part == 1))
    notify("ObjectCreated:Put", 0)
    put("replaced", raw.filter(part == 1))
    files.delete(spark, f"{zones.raw_table('order_products')}/removed")
    put("new", raw.filter(part > 1))
    notify("ObjectRemoved:Delete", 1)
    return readers.read_clean(spark, zones, "order_products")


def notified_training_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From notifications to the training split: cleaning, then curation."""
    return readers.read_ml_split(spark, notified(spark, sf_dir, then=curate_all), "train")


LOADS = 3
SQL_JOB = """
    SELECT u.user_orders, count(DISTINCT u.user_id) AS users, sum(f.up_orders) AS lines, max(p.prod_orders) AS most_sold
    FROM user_features u JOIN up_features f USING (user_id) JOIN product_features p USING (product_id)
    GROUP BY u.user_orders
"""


def incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair features after history came in loads, one of them twice."""
    basket = Basket(tune(spark), sf_dir)
    zones = Zones.under(scratch(spark, "loads"))
    for load in [*range(LOADS), 1]:
        mine = (F.col("order_id") % LOADS) == load
        lines, orders = basket.order_products.filter(mine), basket.orders.filter(mine)
        history.add_load(spark, zones, purchases.prior_lines(lines, orders), load)
    history.write_features(spark, zones)
    return readers.read_curated(spark, zones, "up_features")


def grown_zones(spark: SparkSession, sf_dir: str) -> Zones:
    """Zones whose raw tables came in loads, each cleaned and then curated. The
    lines of an order come with it, a load before, or a load after."""

    def grow() -> Zones:
        zones = Zones.under(scratch(tune(spark), "grown"))
        for load in range(LOADS):
            for table, raw in dirty_tables(spark, sf_dir).items():
                if table == "orders":
                    raw = raw.filter(F.pmod(F.col("order_id").try_cast("bigint"), F.lit(LOADS)) == load)
                elif table == "order_products":
                    raw = raw.filter(F.pmod(F.hash("order_id"), F.lit(LOADS)) == load)
                elif load:
                    continue
                load_table(raw, zones, table, load=load, replace=not load)
            history.curate_new(spark, zones)
        return zones

    return once(spark, ("grown", sf_dir), grow)


def grown_table(table: str) -> Query:
    """A curated table that grew by loads."""
    return lambda spark, sf_dir: readers.read_curated(spark, grown_zones(spark, sf_dir), table)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the curated tables as the job wrote them, by database."""
    zones = Zones.under(scratch(tune(spark), "catalog"))
    write_raw(spark, sf_dir, zones, list(schemas.DECLARED))
    run_all(spark, zones)
    database = f"shop_{uuid.uuid4().hex[:8]}"
    catalog.register_database(spark, zones, database)
    return spark.sql(
        f"""
        SELECT m.eval_set, count(*) AS rows, count(DISTINCT m.user_id) AS users,
               sum(f.prod_orders) AS product_lines
        FROM {database}.ml_dataset m JOIN {database}.product_features f USING (product_id)
        GROUP BY m.eval_set
        """
    )


def sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the SQL job wrote of curated tables that grew by loads."""
    zones = grown_zones(spark, sf_dir)
    folder = scratch(spark, "sql-result")
    main(["sql", "--curated", zones.curated, "--output", folder, "--query", SQL_JOB])
    return spark.read.parquet(folder)


def notifications_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = mapping.notifications(tune(spark), sf_dir)
    return notifications.validate_notifications(messages).select("event_id", "valid", "reason")


def latest_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifacts.latest(mapping.artifacts(tune(spark), sf_dir))


def predictions_upsert(basket: Basket) -> DataFrame:
    """The prediction table after a second batch."""
    spark, old = basket.orders.sparkSession, basket.predictions
    zones = Zones.under(scratch(spark, "predictions"))
    even = (F.col("product_id").cast("bigint") % 2) == 0
    predictions.upsert(spark, zones, old)
    predictions.upsert(spark, zones, old.filter(even).withColumn(serve.SCORE, F.col(serve.SCORE) + 0.001))
    return predictions.read(spark, zones)


def top3_one_user(basket: Basket) -> DataFrame:
    """From the written table, of which one bucket is read."""
    spark = basket.orders.sparkSession
    zones = Zones.under(scratch(spark, "predictions"))
    predictions.upsert(spark, zones, basket.predictions)
    return serve.lookup(predictions.read(spark, zones, ONE_USER), ONE_USER)


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    basket = Basket(tune(spark), sf_dir).keep_pairs()
    catalog.register_frames(
        {
            "product_features": basket.product_features,
            "products": basket.products,
            "departments": basket.tables["departments"],
        }
    )
    return spark.sql(
        """
        SELECT d.department, count(*) AS products, sum(f.prod_orders) AS lines,
               max(f.prod_reorder_rate) AS best_reorder_rate
        FROM product_features f JOIN products p USING (product_id) JOIN departments d USING (department_id)
        GROUP BY d.department
        """
    )


# How far the mean score may be from the label rate of a split.
NEAR = 0.1


def train_and_score(basket: Basket) -> DataFrame:
    """How a model trained on one split does on both, as a compact set."""
    ml_set = stored(basket.ml_set(), "ml-set")
    model = recommend.train(mlset.split(ml_set, "train"))
    both = [
        recommend.evaluate(model, mlset.split(ml_set, name)).select(
            F.lit(name).alias("eval_set"),
            "rows",
            "pairs",
            "in_range",
            (F.col("log_loss") < F.col("base_log_loss")).alias("beats_base_rate"),
            (F.abs(F.col("mean_score") - F.col("label_rate")) < NEAR).alias("near_label_rate"),
        )
        for name in ("train", "test")
    ]
    return both[0].unionByName(both[1])


# The hand-set model of `score_fixed_model`: intercept and coefficients.
INTERCEPT = -1.5
COEFFICIENTS = {"up_order_rate": 2.0, "user_reorder_ratio": 1.25, "prod_reorder_rate": 0.75, "up_orders": -0.125}


def fixed_model(spark: SparkSession) -> PipelineModel:
    weights = Vectors.dense([COEFFICIENTS.get(name, 0.0) for name in recommend.NUMERIC])
    java = spark.sparkContext._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "fixed", _py2java(spark.sparkContext, weights), INTERCEPT
    )
    assembler = VectorAssembler(inputCols=recommend.NUMERIC, outputCol="features", handleInvalid="keep")
    return PipelineModel([assembler, LogisticRegressionModel(java)])


def score_fixed_model(basket: Basket) -> DataFrame:
    """The test split scored by hand-set coefficients, to six digits."""
    scored = recommend.score(fixed_model(basket.orders.sparkSession), basket.split("test"))
    return scored.withColumn(serve.SCORE, F.round(serve.SCORE, 6))


def product_onehot(basket: Basket) -> DataFrame:
    """The one-hot vectors, whole as text, beside their index and size."""
    encoded = encode.product_onehot(basket.products, stored(basket.product_features, "product-features"))

    def vector(name: str) -> F.Column:
        return F.array_join(vector_to_array(f"{name}_encoded").cast("array<int>"), "")

    return encoded.select(
        "product_id",
        *(f"{name}_index" for name in encode.ENCODED),
        *(vector(name).alias(f"{name}_encoded") for name in encode.ENCODED),
        *(f"{name}_size" for name in encode.ENCODED),
    )


QUERIES: dict[str, Query] = {
    "clean_orders_kept": kept("orders"),
    "clean_orders_rejects": rejected("orders"),
    "clean_order_products_kept": kept("order_products"),
    "clean_order_products_rejects": rejected("order_products"),
    "quality_report": quality_report,
    "orphans_aisle": orphaned("aisle"),
    "orphans_department": orphaned("department"),
    "orphans_product": orphaned("product"),
    "orphans_order": orphaned("order"),
    "order_products_prior": over_basket(lambda b: b.prior),
    "user_features": over_basket(lambda b: b.user_features),
    "user_features_in_order": over_basket(user_features_in_order),
    "jobs_by_arguments": jobs_by_arguments,
    "user_product_features": over_basket(lambda b: b.up_features),
    "purchase_sequence": over_pairs(lambda b: purchases.purchase_sequence(b.occasions)),
    "product_features": over_pairs(lambda b: b.product_features),
    "product_onehot": over_pairs(product_onehot),
    "target_orders": over_basket(lambda b: b.targets),
    "ml_labels": over_basket(lambda b: b.labels),
    "ml_user_restricted": over_basket(lambda b: repeat_rows(b.target_users)),
    "ml_attach_up": over_pairs(lambda b: b.with_up),
    "ml_attach_product": over_pairs(
        lambda b: mlset.attach_product(
            b.labels.select("product_id", "order_id"), stored(b.product_features, "product-features")
        )
    ),
    "ml_attach_user": over_pairs(lambda b: repeat_rows(b.with_user)),
    "ml_cross_features": over_pairs(lambda b: repeat_rows(mlset.cross_features(b.with_user))),
    "ml_training_data": over_pairs(lambda b: b.split("train")),
    "ml_test_data": over_pairs(lambda b: b.split("test")),
    "labels_with_features": over_pairs(
        lambda b: repeat_rows(mlset.labels_with_features(b.labels, b.ml_set()))
    ),
    "jobs_training_data": jobs_training_data,
    "train_and_score": over_pairs(train_and_score),
    "score_fixed_model": over_pairs(score_fixed_model),
    "quarantine_rows": quarantine_rows,
    "repeated_lines": over_basket(lambda b: mlset.repeated_lines(b.order_products)),
    "top3_all_users": over_basket(lambda b: serve.top_k(b.predictions)),
    "top3_one_user": over_basket(top3_one_user),
    "predictions_upsert": over_basket(predictions_upsert),
    "latest_artifact": latest_artifact,
    "notifications_valid": notifications_valid,
    "incremental_clean": incremental_orders,
    "notified_clean": notified_order_products,
    "notified_prefix": notified_prefix,
    "notified_replaced_file": notified_replaced_file,
    "notified_training_data": notified_training_data,
    "incremental_features": incremental_features,
    "incremental_history": grown_table("order_products_prior"),
    "incremental_users": grown_table("user_features"),
    "incremental_pairs": grown_table("up_features"),
    "incremental_products": grown_table("product_features"),
    "incremental_curated": lambda spark, sf_dir: readers.read_ml_split(spark, grown_zones(spark, sf_dir), "train"),
    "catalog_tables": catalog_tables,
    "catalog_sql": catalog_sql,
    "sql_job": sql_job,
}
