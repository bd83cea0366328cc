import brute
import pytest
from conftest import SMALL
from corpora import passage

import corpus_pipeline
from basketflow.llm import decontaminate, toxicity


@pytest.fixture(scope="module")
def stages(spark):
    """(documents before, documents after) of each stage over the small tables."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def by_id(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_each_stage_returns_the_columns_of_documents(stages):
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == corpus_pipeline.COLUMNS


def test_rejected_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = {r.doc_id for r in toxicity.toxicity(before, labels).collect() if not r.predicted}
    assert set(by_id(after)) == clean


def test_one_document_of_each_group_stays(stages):
    before, after = (list(by_id(frame).items()) for frame in stages["near_dedup"])
    assert {d for d, *_, kept in brute.near_duplicates(before, corpus_pipeline.NEAR_PERCENT) if kept} == {d for d, _ in after}


def test_repeated_passages_go(stages):
    before, after = (by_id(frame) for frame in stages["substrings"])
    expected = {d: (n, gone) for d, n, gone, _ in brute.repeated_words(list(before.items()), 13)}
    assert set(after) == {d for d, (n, gone) in expected.items() if gone == 0 or gone < n}
    for doc, text in after.items():
        n, gone = expected[doc]
        assert len(brute.words(text)) == n - gone
        assert gone or text == before[doc]


def test_documents_with_items_go(spark, stages):
    before, after = stages["decontaminate"]
    found = decontaminate.contamination(before, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert set(by_id(after)) == {r.doc_id for r in found.collect() if not r.contaminated}


def test_all_that_is_left_is_packed(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(by_id(before))
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(r.length for r in rows) == sum(tokens.values())


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages["packing"][1].count()


def test_repeated_and_unnamed_documents(spark):
    rows = [(None, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (1, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SMALL), f"odd-{name}")
        assert after.count() > 0
        docs = after
    assert docs.count() == 2


def test_near_copies_are_linked_from_four_fifths_up(spark):
    """Pairs of similarity 0.80 to 0.85, and one just below."""
    rows, at = [], []
    for i in range(12):
        words = passage(3000 + i, 94).split(" ")
        other = [*words[: 84 + i % 3 - 1], *passage(4000 + i, 10 - i % 3 + 1).split(" ")]
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join(other), "en", "s", 1)]
        a, b = (brute.shingles(t) for _, t, *_ in rows[-2:])
        at.append(len(a & b) / len(a | b))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    after = corpus_pipeline.keep_one_of_each_group(spark, docs, SMALL)
    expected = {d for d, *_, kept in brute.near_duplicates([r[:2] for r in rows], 80) if kept}
    assert {r.doc_id for r in after.collect()} == expected
    assert sum(0.8 <= x < 0.85 for x in at) >= 6 and min(at) < 0.8
    assert expected != {d for d, *_, kept in brute.near_duplicates([r[:2] for r in rows]) if kept}
