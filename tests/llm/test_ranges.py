"""Exchanges in two steps, numbers beyond 32 bits, and ids that are no keys."""

import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from corpora import changed, corpus, documents, passage  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from basketflow.llm import minhash, ngrams, spans, suffixes, toxicity
from basketflow.llm.packed import SCHEMA, Ranges, gather, pieces, refined
from basketflow.llm.texts import MISSING_ID, as_texts
from conftest import SMALL

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_pieces_stay_large_with_the_buckets_of_a_large_table(spark):
    """The bucket count of 10 TB for op7: a task of the first step and a batch
    of the second deal into few enough ranges for 1,000 keys a piece."""
    ranges = Ranges(10 * 10**12 // spans.BYTES_PER_EDGE)
    assert ranges.deep and ranges.at_once >> (ranges.bits - ranges.level) >= 1_000
    # The same in small, run: 2 ** 9 buckets from 2 ** 3 ranges of 2 ** 6.
    small = Ranges(keys=1 << 18, per_bucket=512, level=3, at_once=1 << 16)
    assert small.bits == 9 and small.deep

    def local(batches):
        for batch in batches:
            for part in batch.column("id").to_pylist():
                keys = np.sort(np.random.default_rng(part).integers(0, 1 << 63, 8192).astype(np.uint64) * np.uint64(2))
                keys[0] = 5  # in every slice
                yield from pieces(small.first(keys), [keys, np.ones(len(keys), np.int64)])

    def send(keys, counts):
        keys, counts = ngrams._grouped(keys, counts)
        yield from pieces(small.fine(keys), [keys, counts])

    sent = spark.range(32).repartition(4).mapInArrow(local, SCHEMA)
    found = refined(sent, small, [np.uint64, np.int64], send).toPandas()
    keys, counts = gather(found, [np.uint64, np.int64])
    assert counts.sum() == 32 * 8192 and counts[keys == 5].sum() == 32
    assert (keys == 5).sum() <= 12  # once a batch, not once a slice
    assert set(found["bucket"]) == set(range(512))
    assert len(found) < 32 * 512 / 4
    pure = [np.unique(small.fine(gather(row, [np.uint64])[0])) for _, row in found.groupby(found.index)]
    assert all(len(x) == 1 for x in pure)


def test_repeated_words_in_two_steps(documents):
    ranges = Ranges(keys=4000, per_bucket=60, level=2, at_once=700)
    assert ranges.deep
    found = spans.remove_repeats(documents, ranges=ranges).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        brute.repeated_words(corpus(), spans.WINDOW), key=repr
    )


@pytest.mark.parametrize("narrow", [ngrams.NARROW, 1])
def test_perplexity_in_two_steps_and_with_wide_pairs(documents, narrow):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    ranges = Ranges(200, 10, 1, 50), Ranges(4000, 60, 2, 700)
    assert all(r.deep for r in ranges)
    key = lambda r: (repr(r[:5]), r[5], r[6])
    one, two = (
        sorted(map(tuple, ngrams.perplexities(documents, *how).select(columns).collect()), key=key)
        for how in ((), (ranges, narrow))
    )
    assert len(one) == len(corpus())
    for a, b in zip(one, two, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_counts_and_word_numbers_beyond_32_bits(tmp_path):
    keys, counts = ngrams._grouped(np.array([7, 7, 3], np.uint64), np.array([3_000_000_000, 3_000_000_000, 1]))
    assert counts.tolist() == [1, 6_000_000_000]
    ngrams.save(f"{tmp_path}/0.counts", ngrams.narrowest(counts))
    model = ngrams.Model(str(tmp_path), Ranges(8), Ranges(8))
    assert model.counts("0.counts", 2).tolist() == [1, 6_000_000_000]
    before, after = np.array([1 << 33, 5, 1 << 33]), np.array([0, 1 << 40, 1 << 32])
    pairs = ngrams._joined(before, after, True)
    assert [x.tolist() for x in ngrams._parts(pairs)] == [before.tolist(), after.tolist()]
    assert np.argsort(pairs).tolist() == [1, 0, 2]
    assert len(np.unique(ngrams._hashed(pairs))) == 3


def test_long_texts_are_searched_piece_by_piece():
    data = np.random.default_rng(6).integers(97, 100, 5000).astype(np.uint8).tobytes().decode()
    texts = as_texts(pa.array([data[:3000], "", data[2000:], "short"]))
    whole, pieced = suffixes.Anchors(texts, 64), suffixes.Anchors(texts, 64, piece=70)
    for name in ("row", "at", "low", "high", "key"):
        assert getattr(whole, name).tolist() == getattr(pieced, name).tolist()


def test_rows_without_id_meet_their_own_class_only(spark):
    texts = [changed(passage(1, 200), i, 1) for i in range(40)] + [passage(2, 30)] * 5
    named = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    keys = [minhash.set_key(s) for s in minhash.shingle_sets(as_texts(pa.array(texts)))]
    known = spark.createDataFrame(list(zip(texts, keys)), "text string, c binary")
    classes = known.select("c", F.lit(MISSING_ID).alias("id"), F.xxhash64("text").alias("h")).distinct()
    keyed = named.select(F.lit(MISSING_ID).alias("id"), F.xxhash64("text").alias("h"))
    assert keyed.join(classes, ["id", "h"]).count() == len(texts)
    found = minhash._texts_of(named, classes).collect()
    assert len(found) == len({bytes(r.c) for r in found}) == len(set(keys))


def test_one_row_without_id_leaves_the_survivors_as_they_are(spark):
    data = [(100 - i, changed(passage(i % 5, 90), i, 1)) for i in range(40)]
    odd = [(None, passage(77, 50)), (None, data[3][1]), (data[8][0], passage(78, 50))]
    one = spark.createDataFrame(data, "doc_id long, text string")
    two = spark.createDataFrame([*odd, *data[::-1]], "doc_id long, text string").repartition(3)
    stay = {tuple(r) for r in minhash.keep_first(one).collect()}
    assert {tuple(r) for r in minhash.keep_first(two).collect()} == stay | {odd[0], odd[2]}
    least = {}
    for doc, _, component, kept in brute.near_duplicates(data):
        least.setdefault(component, []).append((doc, kept))
    assert all(kept == (doc == min(group)[0]) for group in least.values() for doc, kept in group)
    assert len(stay) < len(data)


def test_rows_without_id_repeat_each_other(spark):
    shared, rows = passage(1, 60), []
    for i in range(3):
        rows.append((None, f"{passage(10 + i, 20)} {shared}", "en", f"s{i}", 1))
    rows += [(4, passage(20, 30), "en", "s", 1), (5, None, "en", "null", 1), (6, "", "en", "empty", 0)]
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(2)
    after = {r.source: r for r in corpus_pipeline.drop_repeated_passages(spark, docs, SMALL).collect()}
    assert set(after) == {"s0", "s1", "s2", "s", "null", "empty"}
    assert sorted(len(brute.words(after[f"s{i}"].text)) for i in range(3)) == [20, 20, 80]
    assert all(after[f"s{i}"].doc_id is None for i in range(3)) and after["s"].doc_id == 4
    assert after["null"].text is None and after["empty"].text == ""


def test_a_null_text_stays_null_among_keyed_documents(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0)], DOCUMENT)
    after = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, SMALL).collect()}
    assert after == {1: None, 2: ""}


def test_short_items_cost_no_document_its_place(spark, tmp_path):
    items = [(1, "cat"), (2, passage(5, 7)), (3, passage(6, 8))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [f"a cat {passage(30, 9)}", f"{passage(5, 7)} end", f"begin {passage(6, 8)} end"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCUMENT)
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {0, 1}


def test_stages_without_documents(spark):
    docs = spark.createDataFrame([], DOCUMENT)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def labelled(spark, n):
    data = [(i, passage(i, 12) + (" nasty thing" if i % 4 == 0 else "")) for i in range(n)]
    labels = [(i, int(i % 4 == 0)) for i in range(n)]
    return data, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_the_classifier_is_plain_ftrl(spark):
    """Weights and scores against a learner over a dictionary."""
    data, labels = labelled(spark, 240)
    data += [(9000, passage(9, 20_000)), (9001, "")]
    documents = spark.createDataFrame(data, "doc_id long, text string")
    rates = toxicity.Rates(epochs=3, l1=1.5, toxic_weight=2.0)
    model = toxicity.train(documents, labels, rates=rates)
    chosen = toxicity.training_rows(documents, labels).orderBy(F.xxhash64("doc_id")).collect()
    assert len(chosen) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(240))
    numbers = {d: f.tolist() for (d, _), f in zip(data, toxicity.features(as_texts(pa.array([t for _, t in data]))))}
    # Two features may share a number.
    assert all(0 <= len(brute.skip_grams(t)) - len(numbers[d]) <= 2 for d, t in data[:240])
    order = np.random.default_rng(toxicity.SEED)
    passes = [i for _ in range(rates.epochs) for i in order.permutation(len(chosen))]
    plain = brute.ftrl([(numbers[chosen[i].doc_id], chosen[i].toxic) for i in passes], rates)
    assert model.bias == pytest.approx(plain.pop(None), rel=1e-6)
    assert set(model.index.tolist()) == set(plain) and len(plain) > 3
    assert model.weight.tolist() == pytest.approx([plain[f] for f in model.index.tolist()], rel=1e-5)
    scores = {r.doc_id: r.score for r in toxicity.score(documents, model, ["doc_id"]).collect()}
    for d, _ in data:
        p = 1 / (1 + np.exp(-(model.bias + sum(plain.get(f, 0) for f in numbers[d]))))
        assert scores[d] == pytest.approx(p, rel=1e-4)


def test_the_sample_is_of_known_documents_one_text_each(spark):
    """Labels of ids that are not there take no place, and an id that repeats
    has one text, whatever the order of its rows."""
    data, _ = labelled(spark, 60)
    again = [(1, passage(500 + i, 9)) for i in range(50)] + [(1, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    documents = spark.createDataFrame([*data, *again], "doc_id long, text string")
    chosen, other = (
        sorted(map(tuple, toxicity.training_rows(d, labels, 30).collect()))
        for d in (documents, documents.orderBy(F.desc("text")).repartition(3))
    )
    assert chosen == other and len(chosen) == len({d for d, *_ in chosen}) == 30
