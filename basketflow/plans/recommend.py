"""Train a reorder model, score the test split, keep the scored table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.operators import artifacts, serve
from basketflow.session import scratch, tune
from basketflow.sources import predictions, readers
from basketflow.sources.zones import Zones

LABEL = "reordered"
COPIES = "copies"
NUMERIC = [name for name in schemas.ML_COLUMNS[4:] if name != "product_name"]
SEED = 7
# A saved model is a folder with this one in it.
SAVED = "/metadata"


def _numbers(ml_set: DataFrame) -> DataFrame:
    """Features as doubles; unknown (a user without history) is 0."""
    return ml_set.withColumns({name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in NUMERIC})


def train(training: DataFrame, trees: bool = False, path: str | None = None) -> PipelineModel:
    """A model of `reordered`, saved to `path` or the shared folder. Rows of a
    compact set weigh their `copies`, which teaches what repeated rows would.

    It is returned as loaded again: a freshly fitted model holds on to its
    session, and cannot be sent to executors once that session has observed
    metrics, which the cleaning does.
    """
    compact = COPIES in training.columns
    weight = {"weightCol": COPIES} if compact else {}
    classifier = (
        GBTClassifier(labelCol=LABEL, maxIter=20, seed=SEED, **weight)
        if trees
        else LogisticRegression(labelCol=LABEL, maxIter=25, regParam=0.01, **weight)
    )
    assembler = VectorAssembler(inputCols=NUMERIC, outputCol="features", handleInvalid="keep")
    weights = [F.col(COPIES).cast("double")] if compact else []
    rows = _numbers(training).select(*NUMERIC, F.col(LABEL).cast("double"), *weights)
    path = path or scratch(training.sparkSession, "model")
    Pipeline(stages=[assembler, classifier]).fit(rows).write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, ml_set: DataFrame) -> DataFrame:
    """(user_id, product_id, predicted_probability), keys as text. Works with
    any model over the numeric features; what else the set holds is ignored."""
    scored = model.transform(_numbers(ml_set.select("user_id", "product_id", *NUMERIC)))
    return scored.select(
        F.col("user_id").cast("string"),
        F.col("product_id").cast("string"),
        vector_to_array("probability")[1].alias(serve.SCORE),
    )


def evaluate(model: PipelineModel, ml_set: DataFrame) -> DataFrame:
    """One row on how a model does on a labelled set: rows, distinct pairs,
    rows with a probability within 0 and 1, the log loss of the model and of
    the label rate alone, and the mean score and label. Rows of a compact set
    count as often as their `copies` say."""
    label = F.col(LABEL).cast("double")
    p = vector_to_array("probability")[1]
    often = F.col(COPIES) if COPIES in ml_set.columns else F.lit(1)
    scored = model.transform(_numbers(ml_set)).select(
        "user_id", "product_id", label.alias("y"), p.alias("p"), often.cast("bigint").alias("n")
    )

    def mean(value):
        known = F.when(value.isNotNull(), F.col("n"))
        return F.sum(value * F.col("n")) / F.sum(known)

    safe = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = mean(-F.when(F.col("y") == 1, F.log(safe)).otherwise(F.log(1 - safe)))
    rate = mean(F.col("y"))
    entropy = F.when(rate.between(1e-9, 1 - 1e-9), -rate * F.log(rate) - (1 - rate) * F.log(1 - rate)).otherwise(0.0)
    return scored.agg(
        F.sum("n").alias("rows"),
        F.count_distinct("user_id", "product_id").alias("pairs"),
        F.sum(F.when(F.col("p").between(0, 1), F.col("n")).otherwise(0)).alias("in_range"),
        loss.alias("log_loss"),
        entropy.alias("base_log_loss"),
        mean(F.col("p")).alias("mean_score"),
        rate.alias("label_rate"),
    )


def newest_model(spark: SparkSession, folder: str) -> str:
    """The model saved last below a folder."""
    listed = artifacts.listing(spark, folder).filter(~F.col("key").contains("/stages/"))
    saved = listed.withColumn("key", F.regexp_replace("key", f"{SAVED}/part-[^/]*$", SAVED))
    return artifacts.latest_key(saved, prefix="", suffix=SAVED).removesuffix(SAVED)


def train_job(spark: SparkSession, zones: Zones, model_path: str, trees: bool = False) -> None:
    tune(spark)
    train(readers.read_ml_split(spark, zones, "train"), trees, model_path)


def score_job(spark: SparkSession, zones: Zones, model_path: str | None, models: str | None = None) -> list[int]:
    """Score the test split into the prediction table; returns the buckets
    written. The model is the one at `model_path`, or else the newest below the
    folder `models`."""
    tune(spark)
    model = PipelineModel.load(model_path or newest_model(spark, models))
    return predictions.upsert(spark, zones, score(model, readers.read_ml_split(spark, zones, "test")))
