"""Top products, keyed upsert, latest artifact, model."""

from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.operators import artifacts, serve
from basketflow.plans import recommend

SCORED = "user_id string, product_id string, predicted_probability double"


def scored(spark, rows, schema=SCORED):
    return spark.createDataFrame(rows, schema)


def test_ties_go_by_product_id_as_text(spark):
    rows = [("1", "2", 0.5), ("1", "10", 0.5), ("1", "3", 0.9), ("1", "1", 0.5), ("2", "7", 0.1)]
    got = serve.top_k(scored(spark, rows)).orderBy("user_id", "position").collect()
    assert [(r.user_id, r.product_id) for r in got] == [("1", "3"), ("1", "1"), ("1", "10"), ("2", "7")]


def test_missing_and_text_scores(spark):
    rows = [("1", "a", None), ("1", "b", "0.2"), ("1", "c", "-0.1"), ("1", "d", "high")]
    got = serve.top_k(scored(spark, rows, SCORED.replace("double", "string")), k=4).orderBy("position")
    assert [r.product_id for r in got.collect()] == ["b", "a", "d", "c"]


def test_lookup(spark):
    table = scored(spark, [("1", "a", 0.1), ("2", "b", 0.2), ("1", "c", 0.3)])
    assert [r.product_id for r in serve.lookup(table, "1").collect()] == ["c", "a"]
    assert serve.lookup(table, "9").count() == 0
    for nobody in (None, ""):
        with pytest.raises(ValueError, match="user_id is required"):
            serve.lookup(table, nobody)


def test_upsert_replaces_adds_and_keeps(spark):
    old = scored(spark, [("1", "a", 0.1), ("1", "b", 0.2)])
    new = scored(spark, [("1", "b", None), ("2", "a", 0.9)])
    got = serve.upsert_predictions(old, new)
    assert sorted(map(tuple, got.collect())) == [("1", "a", 0.1), ("1", "b", None), ("2", "a", 0.9)]


def test_upsert_takes_the_latest_of_a_batch(spark):
    old = scored(spark, [])
    new = scored(spark, [("1", "a", 0.9, 1), ("1", "a", 0.1, 2), ("1", "a", 0.2, 2)], SCORED + ", at int")
    assert [tuple(r) for r in serve.upsert_predictions(old, new, "at").collect()] == [("1", "a", 0.2)]


LISTING = [
    ("output/a/output/model.tar.gz", datetime(2024, 1, 2)),
    ("output/c/output/model.tar.gz", datetime(2024, 1, 3)),
    ("output/b/output/model.tar.gz", datetime(2024, 1, 3)),
    ("output/d/logs.txt", datetime(2024, 1, 9)),
    ("other/e/output/model.tar.gz", datetime(2024, 1, 9)),
]


def test_latest_artifact(spark):
    listing = spark.createDataFrame(LISTING, "key string, last_modified timestamp")
    assert artifacts.latest_key(listing) == "output/b/output/model.tar.gz"
    with pytest.raises(LookupError):
        artifacts.latest_key(listing.filter("key like '%logs.txt'"))


def ml_rows(spark, rows):
    """rows: (user, product, label, up_orders); other features are null."""
    schema = ", ".join(
        f"{name} {'string' if name in ('eval_set', 'product_name') else 'bigint' if name in ('product_id', 'user_id', 'reordered', 'up_orders') else 'double'}"
        for name in schemas.ML_COLUMNS
    )
    filled = [
        tuple({"product_id": p, "user_id": u, "reordered": y, "up_orders": n}.get(name) for name in schemas.ML_COLUMNS)
        for u, p, y, n in rows
    ]
    return spark.createDataFrame(filled, schema)


def test_scoring_works_in_a_session_that_observed_metrics(spark):
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    training = ml_rows(spark, [(u, p, p % 2, p) for u in range(4) for p in range(6)])
    assert len(recommend.score(recommend.train(training), training).collect()) == 24


@pytest.mark.parametrize("trees", [False, True])
def test_model_learns_that_bought_means_bought_again(spark, trees):
    training = ml_rows(spark, [(u, p, int(p > 5), p if p > 5 else 0) for u in range(12) for p in range(10)])
    model = recommend.train(training, trees)
    got = {r.product_id: r.predicted_probability for r in recommend.score(model, training).collect()}
    assert all((got[str(p)] > 0.5) == (p > 5) for p in range(10))
    assert recommend.score(model, training).dtypes == [
        ("user_id", "string"),
        ("product_id", "string"),
        ("predicted_probability", "double"),
    ]


def test_weights_teach_what_repeated_rows_do(spark):
    """Coefficients, and the evaluation, of a compact set and of its rows. The
    spread by which Spark scales a feature is estimated a little differently
    from weights, which the penalty then shows."""
    from basketflow.functions.copies import repeat_rows

    columns = {name: (F.hash("id", F.lit(name)) % 7).cast("double") for name in recommend.NUMERIC}
    compact = spark.range(80).select(
        F.col("id").alias("user_id"),
        (F.col("id") % 9).alias("product_id"),
        (F.hash("id", F.lit("label")) % 2 == 0).cast("int").alias("reordered"),
        *(column.alias(name) for name, column in columns.items()),
        (1 + F.col("id") % 4).alias("copies"),
    )
    rows = repeat_rows(compact)
    by_weight, by_rows = recommend.train(compact), recommend.train(rows)
    for a, b in zip(by_weight.stages[-1].coefficients, by_rows.stages[-1].coefficients):
        assert a == pytest.approx(b, abs=2e-3)
    first, second = (recommend.evaluate(by_rows, frame).first() for frame in (compact, rows))
    assert first.asDict() == pytest.approx(second.asDict()) and first["rows"] == rows.count()
