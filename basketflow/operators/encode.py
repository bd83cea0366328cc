"""One-hot aisle and department of products."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.session import stored

ENCODED = ["aisle_id", "department_id"]


def frequent_first(sold: DataFrame, label: str) -> DataFrame:
    """(label, index, labels): the labels by lines sold, most first, ties by
    text, numbered from 0, and how many there are.

    They are dealt by ranges of that order and numbered within their range,
    then moved on by the labels of the ranges before, so however many there
    are, neither one task nor the driver holds them all."""
    counted = sold.groupBy(F.col(label).cast("string").alias("label")).agg(F.sum("prod_orders").alias("n"))
    order = [F.col("n").desc(), F.col("label").asc()]
    known = stored(counted.filter("label IS NOT NULL"), "labels")
    ranged = stored(known.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged-labels")
    ranges = Window.partitionBy(F.lit(0)).orderBy("range")
    starts = ranged.groupBy("range").agg(F.count("*").alias("size")).select(
        "range",
        (F.sum("size").over(ranges) - F.col("size")).alias("start"),
        F.sum("size").over(Window.partitionBy(F.lit(0))).alias("labels"),
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    numbered = ranged.withColumn("place", place).join(starts, "range")
    return numbered.select("label", (F.col("start") + F.col("place")).cast("double").alias("index"), "labels")


def product_onehot(products: DataFrame, product_features: DataFrame) -> DataFrame:
    """Product features with the index of aisle and department, the size of
    their one-hot vectors (the last label has no place of its own), and these
    vectors, which are sparse.

    Indexes go by how many past lines a label has, most frequent first. Those
    are the sum of prod_orders over its products; history is not read.
    """
    sold = products.join(product_features.select("product_id", "prod_orders"), "product_id")
    indexed = sold.select("product_id", *ENCODED).distinct()
    for name in ENCODED:
        labels = frequent_first(sold, name)
        found = labels.select(
            F.col("label").alias(f"{name}_label"),
            F.col("index").alias(f"{name}_index"),
            (F.col("labels") - 1).alias(f"{name}_size"),
        )
        indexed = indexed.join(found, F.col(name).cast("string") == F.col(f"{name}_label")).drop(f"{name}_label")
    indexed = stored(indexed.drop(*ENCODED), "indexed-products")
    encoder = OneHotEncoder(
        inputCols=[f"{name}_index" for name in ENCODED], outputCols=[f"{name}_encoded" for name in ENCODED]
    )
    if indexed.isEmpty():
        none = array_to_vector(F.lit([]).cast("array<double>"))
        encoded = indexed.withColumns({name: none for name in encoder.getOutputCols()})
    else:
        encoded = encoder.fit(indexed).transform(indexed)
    return product_features.join(encoded, "product_id", "left")
