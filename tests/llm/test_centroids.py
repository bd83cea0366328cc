"""Centroid clustering against every vector and every centroid each round."""

import brute
import numpy as np
import pytest
from conftest import final_plan

from basketflow.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def found(frame):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=repr)


def clouds(n, width, seed):
    """Vectors around a few middles, some of them equal, some halfway."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, width))
    rows = [(i, (middles[i % 5] + rng.normal(size=width) * 0.4).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(20)]
    rows += [(n + 20 + i, ((middles[i % 5] + middles[(i + 1) % 5]) / 2).astype(np.float32).tolist()) for i in range(9)]
    return rows


@pytest.mark.parametrize("block, buckets", [(centroids.BLOCK, 16), (16, 3)])
def test_equals_plain_rounds(spark, monkeypatch, block, buckets):
    monkeypatch.setattr(centroids, "BLOCK", block)
    monkeypatch.setattr(centroids, "BLOCKS_PER_BUCKET", buckets)
    rows = clouds(150, 6, 1)
    odd = [(900, None), (901, [1.0] * 5), (902, [None] * 6), (903, [float("nan")] * 6), (904, []), (None, [1.0] * 6)]
    odd += [(905, [float("inf")] * 6), (3, rows[7][1]), (3, rows[8][1]), (906, [-0.0] * 6), (907, [100.0] * 6)]
    frame = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS cluster", "2 AS block").repartition(3)
    out = centroids.cluster(frame, k=4, rounds=5, width=6)
    assert found(out) == sorted(brute.lloyd(rows + odd, 4, 5, 6), key=repr)


def test_few_equal_and_no_vectors(spark):
    def both(rows, k):
        frame = spark.createDataFrame(rows, SCHEMA)
        return found(centroids.cluster(frame, k=k, rounds=3, width=2)), sorted(brute.lloyd(rows, k, 3, 2), key=repr)

    for rows, k in [([(1, [1.0, 2.0]), (2, [3.0, 2.0])], 8), ([(i, [1.0, 1.0]) for i in range(9)], 3),
                    ([(i, [float(i), 0.5]) for i in range(12)], 1), ([(5, None)], 2)]:
        out, expected = both(rows, k)
        assert out == expected


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e20, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="vector component"):
        centroids.cluster(frame, width=2).collect()


def test_only_expired_vectors_are_rescanned():
    rng = np.random.default_rng(4)
    data = np.concatenate([rng.normal(c * 4000, 300, (200, 8)) for c in range(4)]).astype(np.int64)
    now, heaps, drifted, sums, looked = data[[0, 210, 420, 630]], None, [0] * 4, np.zeros((4, 9), np.int64), []
    for _ in range(6):
        heaps, moved, n = centroids.turn(data, heaps, now, drifted)
        looked.append(n)
        sums += moved
        cluster = np.empty(len(data), int)
        for j, heap in enumerate(heaps):
            assert (heap[:1] == heap.min()).all() if len(heap) else True
            cluster[heap & (centroids.BLOCK - 1)] = j
        assert (cluster == centroids.distances(data, now).argmin(axis=1)).all()
        after = sums[:, 1:] // sums[:, :1]
        steps = [centroids.drift(a.tolist(), b.tolist()) for a, b in zip(now, after)]
        drifted = [d + s + max(steps[:j] + steps[j + 1 :]) for j, (d, s) in enumerate(zip(drifted, steps))]
        now = after
    assert looked[0] == len(data) and sum(looked[1:]) < len(data) / 10


def test_blocks_meet_their_heaps_without_an_exchange(spark, monkeypatch):
    plans = []
    kept = centroids.last_assignment

    def seen(rows, *args):
        plans.append(final_plan(rows))
        return kept(rows, *args)

    monkeypatch.setattr(centroids, "last_assignment", seen)
    monkeypatch.setattr(centroids, "BLOCK", 16)
    monkeypatch.setattr(centroids, "BLOCKS_PER_BUCKET", 2)
    tables = spark.catalog.listTables()
    centroids.cluster(spark.createDataFrame(clouds(200, 4, 2), SCHEMA), k=3, width=4).collect()
    assert "Join" in plans[0] and "Exchange" not in plans[0]
    assert spark.catalog.listTables() == tables
