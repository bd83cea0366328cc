"""Connected components of a table of links.

Links are merged by union-find in tasks that take a bounded number of them.
While there are more than one task may take, rounds of large-star and
small-star, which only join and aggregate, do it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.session import stored


# Two 16-byte names a link: some 100 MB in a task's dictionary.
TASK_LINKS = 400_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("v").to_pylist(), batch.column("u").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    kind = batch.schema.field("v").type if root else pa.binary()
    columns = [pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)]
    yield pa.RecordBatch.from_arrays(columns, names=["node", "root"])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the least
    node that can be reached."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")), "links")
    if edges.count() <= task_links:
        kind = edges.schema["v"].dataType.simpleString()
        return stored(edges.coalesce(1).mapInArrow(_union_find, f"node {kind}, root {kind}"), "roots")
    return _stars(edges)


def _stars(edges: DataFrame) -> DataFrame:
    """Each round first ties every larger neighbour of a node to the least node
    of its neighbourhood, then every smaller one; groups become stars in a
    number of rounds that grows with the logarithm of their size. Only minima
    are aggregated, and links to a node that has very many stay spread out."""
    before = None
    while True:
        # v > u in every edge. Large star: neighbours larger than a node.
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (
            edges.join(least.withColumnRenamed("v", "u"), "u")
            .select("v", F.col("m").alias("u"))
            .filter("v <> u")
            .distinct()
        )
        large = stored(large, "large-star")
        # Small star: neighbours not larger, and the node itself.
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(lowest, "v")
            .select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u"))
            .filter("v <> u")
            .distinct()
        )
        edges = stored(small, "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        before = now
