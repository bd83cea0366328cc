"""Importance resampling against plain counting."""

import random

import brute
import numpy as np
import pytest
from corpora import corpus, documents, no_documents, passage  # noqa: F401

from basketflow.llm import resample
from basketflow.llm.texts import SLICE_BYTES, Texts

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]
TARGETS = [passage(10, 60), None, "", passage(11, 40), passage(1, 30), passage(10, 60)]


def texts(values):
    data = [brute.utf8(v) for v in values]
    return Texts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def benchmark(spark, values):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], "item_id long, text string, bucket int")


def found(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("limit", [SLICE_BYTES, 64])
def test_equals_plain_counting(spark, documents, limit):  # noqa: F811
    out = found(resample.resample(documents, benchmark(spark, TARGETS), percent=40, limit=limit))
    assert out == sorted(brute.resampled(corpus(), TARGETS, percent=40), key=repr)


def test_draw_has_no_gap_and_breaks_ties_by_id(spark):
    rows = [(i, passage(3, 40)) for i in range(30)] + [(None, passage(4, 40)), (99, passage(5, 19))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = resample.resample(frame, benchmark(spark, [passage(3, 40)]), percent=50).collect()
    drawn = sorted((r["rank"], -r.score, r.doc_id) for r in out if r["rank"])
    assert [rank for rank, *_ in drawn] == list(range(1, 16))
    assert [d[1:] for d in drawn] == sorted(d[1:] for d in drawn)
    assert next(r for r in out if r.doc_id == 99)["rank"] is None


def test_empty_tables(spark, documents, no_documents):  # noqa: F811
    none = benchmark(spark, [None]).limit(0)
    assert found(resample.resample(no_documents, none)) == []
    assert found(resample.resample(no_documents, benchmark(spark, TARGETS))) == []
    assert found(resample.resample(documents, none)) == sorted(brute.resampled(corpus(), []), key=repr)


@pytest.mark.parametrize("limit", [5, 100, 1 << 20])
def test_runs_of_long_texts_cut_into_pieces(limit):
    rng = random.Random(2)
    for text in ["Ab c-d é9 X", "", "--", "q" * 500 + " " + "r" * 64 + " " + "s" * 63 + " t" * 9,
                 " ".join(f"w{rng.randrange(40)}" for _ in range(400))]:
        counts, words = np.zeros(10_000, np.int64), 0
        for own, _, runs in resample.word_runs(texts([text]), resample.Checksums(), limit):
            words += len(own)
            for run in runs:
                counts += np.bincount(run % np.uint32(10_000), minlength=10_000)
        n, features, expected = brute.bucket_counts(text)
        assert (words, counts.sum(), {b: int(counts[b]) for b in np.flatnonzero(counts)}) == (n, features, expected)


def test_planes_hold_the_exact_weight():
    rng = np.random.default_rng(5)
    gain = rng.integers(-70_000, 90_000, 130)
    key = np.unique(rng.integers(0, 7 * 130, 400))
    counts = rng.integers(1, 2000, len(key))
    signed = [(1, resample.planes(np.maximum(gain, 0))), (-1, resample.planes(np.maximum(-gain, 0)))]
    expected = np.zeros(7, np.int64)
    np.add.at(expected, key // 130, counts * gain[key % 130])
    assert (resample.weigh(key, counts, 7, 130, signed) == expected).all()
