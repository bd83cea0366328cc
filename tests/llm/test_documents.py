"""The document operators against plain versions of themselves, over a corpus
of nulls, empty and long texts, ties, repeated rows and clashing columns."""

import zlib

import brute
import numpy as np
import pytest
from corpora import changed, corpus, documents, no_documents, passage  # noqa: F401

from basketflow.llm import decontaminate, minhash, ngrams, packing, sharding, spans, suffixes, toxicity


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_near_duplicates(documents):
    found = rows(minhash.near_duplicates(documents), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(brute.near_duplicates(corpus()), key=repr)


def test_one_of_each_group_stays(documents):
    kept = minhash.keep_first(documents)
    assert kept.columns == documents.columns
    groups = {}
    for (_, text), (_, n, component, _) in zip(corpus(), brute.near_duplicates(corpus())):
        groups.setdefault(component if n else text, set()).add(text)
    texts = [r.text for r in kept.collect() if brute.shingles(r.text)]
    assert all(sum(t in group for t in texts) == 1 for group in groups.values() if brute.shingles(min(group, key=str)))


def test_a_large_group_of_near_copies_is_one_component(spark):
    """A base with many copies, most of which are not linked to each other,
    and a chain of texts each linked to the next only."""
    base = passage(1, 150)
    texts = [base, *(changed(base, i, 2) for i in range(2, 60))]
    chain = [passage(99, 200)]
    for i in range(12):
        w = chain[-1].split(" ")
        chain.append(" ".join([*w[14:], *passage(200 + i, 14).split(" ")]))
    data = list(enumerate(texts + chain))
    found = rows(
        minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")),
        "doc_id",
        "n_shingles",
        "component_id",
        "kept",
    )
    assert found == sorted(brute.near_duplicates(data), key=repr)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[200:])
    both = minhash.signatures([a, b, a[:3], a[:3], a[:0]], 512)
    assert abs((both[0] == both[1]).mean() - 800 / 1200) < 0.07
    assert (both[2] == both[3]).all()
    alone = minhash.signatures([b], 512)
    assert (alone[0] == both[1]).all()


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_repeated_bytes(documents, hot):
    found = rows(
        suffixes.remove_repeated_bytes(documents, hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    own = [r for r in corpus()]
    # Rows that share an id share the places found in either.
    expected = sorted(brute.repeated_bytes(own, suffixes.SIZE), key=repr)
    twice = {None}
    assert [r for r in found if r[0] not in twice] == [r for r in expected if r[0] not in twice]
    assert len(found) == len(expected)


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_repeated_bytes_of_rows_that_share_an_id(spark, hot):
    """Each row is cut by its own text alone, with a null id or a shared one."""
    long = passage(1, 150)
    data = [(None, long), (None, passage(2, 300)), (None, f"{passage(3, 90)} {long}"), (None, None)]
    data += [(5, passage(4, 300)), (5, f"{long} {passage(6, 90)}"), (5, long), (6, passage(7, 200))]
    found = rows(
        suffixes.remove_repeated_bytes(spark.createDataFrame(data, "doc_id long, text string"), hot=hot),
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept_sha256",
    )
    assert found == sorted(brute.repeated_bytes(data, suffixes.SIZE), key=repr)


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_hot_grams_in_many_surroundings(spark, hot):
    """A phrase within ever other text, a passage that varies at one end, one
    that tasks share, and texts of one letter or two."""
    phrase, whole = passage(1, 14), passage(2, 95)
    texts = [f"{passage(10 + i, 50)} {phrase} {passage(60 + i, 45 + i)}" for i in range(12)]
    texts += [f"{passage(10 + i % 4, 50 + i)} {phrase} {passage(60 + i % 3, 60)}" for i in range(12)]
    texts += [f"{passage(30 + i, 5 * i)} {whole[i:]}" for i in range(10)] + [whole] * 5
    texts += ["a" * 399, "a" * 900, "ab" * 450, f"b{'a' * 700}", "é" * 300]
    data = list(enumerate(texts))
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = rows(suffixes.remove_repeated_bytes(frame, hot=hot), *names)
    assert found == sorted(brute.repeated_bytes(data, suffixes.SIZE), key=repr)
    assert sum(r[2] > 0 for r in found) > 20


def test_repeated_words(documents):
    found = rows(spans.remove_repeats(documents), "doc_id", "n_words", "n_removed", "kept_sha256")
    expected = sorted(brute.repeated_words(corpus(), spans.WINDOW), key=repr)
    assert found == expected


def test_repeated_words_carry_columns_and_text(documents):
    kept = spans.remove_repeats(documents, keep_text=True, carry=["id", "c"]).collect()
    assert {(r.id, bytes(r.c)) for r in kept} == {(7, b"x")}
    for r in kept:
        assert len(brute.words(r.kept_text)) == r.n_words - r.n_removed


def test_a_span_whose_words_differ_is_refused(spark):
    """Two texts under one id: what only one of them shares with an earlier
    document is cut from that one alone."""
    first, other = passage(1, 40), passage(2, 40)
    data = [(1, first), (2, first), (2, other)]
    found = rows(
        spans.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")), "doc_id", "n_words", "n_removed"
    )
    assert found == [(1, 40, 0), (2, 40, 0), (2, 40, 40)]
    kept = spans.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), keep_text=True)
    assert rows(kept, "doc_id", "kept_text") == sorted([(1, first), (2, ""), (2, other)], key=repr)


def test_perplexity(documents):
    found = rows(
        ngrams.perplexities(documents), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
    data = corpus()
    held = [doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _ in data]
    tokens = [[*brute.words(t, lower=True), None] for _, t in data]
    training = [w for w, h in zip(tokens, held) if not h]
    p, preceded = brute.kneser_ney(training)
    count = {}
    for w in training:
        for x in w:
            count[x] = count.get(x, 0) + 1
    total = sum(count.values())
    expected = []
    for (doc, _), h, w in zip(data, held, tokens):
        base = sum(np.log10((count.get(x, 0) + 1) / (total + len(count) + 1)) for x in w)
        score = sum(np.log10(p(a, b)) for a, b in zip([0, *w[:-1]], w))
        expected.append((doc, h, len(w), sum(x in count for x in w), total, base, score))
    expected.sort(key=repr)
    key = lambda r: (repr(r[:5]), r[5], r[6])
    for got, want in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-9)


def test_probabilities_add_up_to_one():
    training = [[b"a", b"b", b"a", b"c", None], [b"a", b"b", b"d", None], [b"e", None]] * 2 + [[b"a", b"f", None]]
    p, preceded = brute.kneser_ney(training)
    for before in (0, b"a", b"b", b"unknown"):
        assert sum(p(before, w) for w in [*preceded, b"unseen"]) == pytest.approx(1)


def test_model_arrays_need_a_mounted_folder():
    assert ngrams.mounted("file:///a/b") == ngrams.mounted("file:/a/b") == ngrams.mounted("/a/b") == "/a/b"
    with pytest.raises(ValueError, match="memory-mapped"):
        ngrams.mounted("hdfs://host/a")


def test_shards(documents):
    placed = sharding.shards(documents, 5).collect()
    assert len(placed) == len(corpus())
    for shard in range(5):
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots)))
        assert len(slots) in (len(placed) // 5, -(-len(placed) // 5))
    expected = sorted(((d, len(brute.utf8(t)) + 8, zlib.crc32(brute.utf8(t))) for d, t in corpus()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in placed), key=repr) == expected
    numbers = np.array([r.number for r in placed])
    to = sharding.permute(numbers, len(placed), 20240229)
    assert [(r.shard, r.slot) for r in placed] == list(zip((to % 5).tolist(), (to // 5).tolist()))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_walk_is_a_permutation(n):
    assert sorted(sharding.permute(np.arange(n), n, 5).tolist()) == list(range(n))


def test_numbers_within_groups_have_no_gap(spark):
    from basketflow.session import stored

    data = [(i % 3, i // 7) for i in range(500)]
    frame = stored(spark.createDataFrame(data, "g int, x int"), "t")
    found = sharding.numbered(frame, ["x"], by=["g"], per_part=40).collect()
    for g in range(3):
        own = sorted(r.number for r in found if r.g == g)
        assert own == list(range(len(own)))


def test_packing(documents):
    from tokenizers import Tokenizer

    found = packing.pack(documents).collect()
    exact = Tokenizer.from_file(packing.default_paths()[0])
    expected = {}
    for doc, text in corpus():
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 1024):
            piece = np.array(ids[start : start + 1024], "<u4")
            key = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
            expected[key] = expected.get(key, 0) + 1
    got = {}
    for r in found:
        key = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
        got[key] = got.get(key, 0) + 1
    assert got == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 1024


@pytest.mark.parametrize(
    "text", ["plain words, 1 2 33  x\n\ny", "<|endoftext|> inside", "été Ünï", "日本語 text", "a​b", "don't we'll"]
)
def test_fast_ids_are_the_exact_ones(text):
    tokenizer = packing.Tokenizer(*packing.default_paths())
    assert tokenizer.ids(text).tolist() == [*tokenizer.exact.encode(text, add_special_tokens=False).ids, 0]


def test_plan_uses_every_length_once_and_wastes_little():
    rng = np.random.default_rng(2)
    counts = np.bincount(rng.integers(1, 1024, 20_000), minlength=1025)
    patterns = packing.plan(counts)
    used = np.zeros(1025, np.int64)
    for pattern in patterns:
        assert sum(pattern.lengths) <= 1024
        for length in pattern.lengths:
            used[length] += pattern.windows
    assert (used == counts).all()
    windows = sum(p.windows for p in patterns)
    tokens = int((counts * np.arange(1025)).sum())
    assert 1 - tokens / (windows * 1024) < 0.01
    assert packing.plan(np.zeros(1025, np.int64)) == []


def test_contamination(spark):
    items = [(i, passage(500 + i, 30 + i)) for i in range(6)] + [(6, "Só."), (7, ""), (8, None), (None, "x")]
    data = []
    for i in range(6):
        for times in range(0, 9, 2):
            noise = changed(items[i][1], 900 + times, times)
            data.append((len(data), f"{passage(700 + times, 25)} {noise.title()}, {passage(800 + i, 20)}"))
    data += [(100, None), (101, ""), (102, passage(5, 400)), (103, "so só!"), (102, items[0][1])]
    found = rows(
        decontaminate.contamination(
            spark.createDataFrame(data, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"),
        ),
        "doc_id",
        "item_ids",
        "distances",
    )
    plain = lambda t: brute.words("".join(c if c.isalnum() else " " for c in t or ""), lower=True)
    expected = []
    for doc, text in data:
        near = []
        for item, words in ((i, plain(t)) for i, t in items):
            if words and (d := brute.edit_distance_within(words, plain(text))) <= len(words) // 8:
                near.append((item, d))
        expected.append((doc, [i for i, _ in near], [d for _, d in near]))
    assert found == sorted(expected, key=repr)
    assert any(0 in d for _, _, d in found) and any(3 in d for _, _, d in found)


def test_an_item_without_id_is_found(spark):
    items = [(None, passage(600, 20)), (1, passage(601, 20)), (None, passage(602, 20))]
    data = [(1, f"{passage(9, 30)} {items[0][1]}"), (2, f"{items[2][1]} {items[1][1]}"), (3, passage(8, 50))]
    found = decontaminate.contamination(
        spark.createDataFrame(data, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows(found, "doc_id", "contaminated", "item_ids") == [
        (1, True, [None]), (2, True, [None, 1]), (3, False, [])
    ]


def test_items_go_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    items = [(i, passage(500 + i, 20)) for i in range(5)]
    data = [(1, " ".join(t for _, t in items)), (2, items[3][1])]
    found = decontaminate.contamination(
        spark.createDataFrame(data, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows(found, "doc_id", "item_ids") == [(1, [0, 1, 2, 3, 4]), (2, [3])]


def test_toxicity_is_learnt(spark):
    data, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = passage(i, 30) + (" nasty" if toxic else "")
        data.append((i, text))
        labels.append((i, int(toxic), 1))
    data += [(9001, None), (9002, ""), (None, "nasty"), (9001, None)]
    labels += [(None, 1, 1), (0, 1, 1), (5, None, None), (77777, 1, 1), (8, 7, 0)]
    documents = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS toxic")
    found = toxicity.toxicity(documents, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    out = found.collect()
    assert len(out) == len(data)
    held = [r for r in out if r.held_out and r.doc_id < 600]
    assert len(held) > 50 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    empty = [r for r in out if r.doc_id in (9001, 9002)]
    assert len(empty) == 3 and len({r.score for r in empty}) == 1 and empty[0].predicted == 0


def test_without_documents_there_are_no_rows(spark, no_documents):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    for frame in (
        minhash.near_duplicates(no_documents),
        minhash.keep_first(no_documents),
        suffixes.remove_repeated_bytes(no_documents),
        toxicity.toxicity(no_documents, labels),
        packing.pack(no_documents),
        sharding.shards(no_documents),
        spans.remove_repeats(no_documents),
        ngrams.perplexities(no_documents),
        decontaminate.contamination(no_documents, items),
    ):
        assert frame.count() == 0


def test_without_labels_or_items_documents_stay_clean(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(documents, labels).collect()} == {0}
    items = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontaminate.contamination(documents, items).collect()} == {False}


@pytest.mark.parametrize("task_links", [0, 1000])
def test_components(spark, task_links):
    from basketflow.llm.components import components

    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(200 + i, 201 + i) for i in range(40)]
    links += [(300, 300 + i) for i in range(1, 30)] + [(7, 7)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(links, "a long, b long"), task_links)
    expected = {x: find(x) for link in links if link[0] != link[1] for x in link}
    assert {r.node: r.root for r in found.collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long"), task_links).count() == 0


def test_near_duplicates_in_many_small_blocks(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 500)
    found = rows(minhash.near_duplicates(documents), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(brute.near_duplicates(corpus()), key=repr)


@pytest.mark.parametrize("hot", [50_000, 30])
def test_shards_do_not_depend_on_files(spark, hot):
    """Small parts, with copies under one id, and under none."""
    rows_ = [(i, passage(i, 5)) for i in range(150)] + [(7, "same")] * 60 + [(None, "none")] * 45 + [(None, None)] * 3
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    found = [
        rows(sharding.shards(frame.repartition(n), 5, per_part=40, hot=hot), "doc_id", "size", "text_crc32", "shard", "slot")
        for n in (1, 6)
    ]
    assert found[0] == found[1]
    places = sorted((shard, slot) for *_, shard, slot in found[0])
    assert places == sorted((p % 5, p // 5) for p in range(len(rows_)))
