import random

import brute
import numpy as np
import pyarrow as pa
from corpora import corpus

from basketflow.llm import packed, suffixes
from basketflow.llm.texts import as_texts, slices


def texts_of(rows):
    return as_texts(pa.array([t for _, t in rows], pa.string()))


def test_words_are_those_of_the_pattern():
    rows = corpus()
    found = texts_of(rows).words(lower=True)
    for i, (_, text) in enumerate(rows):
        own = range(found.bounds[i], found.bounds[i + 1])
        assert [found.word(j) for j in own] == brute.words(text, lower=True)


def test_equal_windows_have_equal_hashes_and_others_not():
    rows = corpus()
    found = texts_of(rows).words()
    at, keys = found.windows(4)
    names = {}
    for a, key in zip(at.tolist(), keys.tolist()):
        names.setdefault(key, set()).add(tuple(found.word(j) for j in range(a, a + 4)))
    assert all(len(x) == 1 for x in names.values())
    assert len({x for s in names.values() for x in s}) == len(names)


def test_slices_keep_all_rows_and_their_order():
    rows = corpus()
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows])], names=["text"])
    got = [texts.text(i) for _, texts in slices([batch, batch], limit=100) for i in range(len(texts))]
    assert got == [brute.utf8(t) for _, t in rows] * 2


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for kind in (np.uint64, np.int64, np.int32, np.uint16):
        values = np.sort(rng.integers(0, 60_000, 1000).astype(kind))
        for ordered in (False, True):
            assert (packed.unpack(packed.pack(values, ordered), kind, ordered) == values).all()
        assert not len(packed.unpack(packed.pack(values[:0], True), kind, True))


def test_loser_tree_orders_strings_and_knows_shared_prefixes():
    rng = random.Random(3)
    for count in (1, 2, 3, 7):
        runs = []
        for _ in range(count):
            strings = sorted("".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode() for _ in range(12))
            runs.append((strings, [0, *(suffixes.shared(a, b) for a, b in zip(strings, strings[1:]))]))
        order = list(suffixes.merged(runs))
        strings = [runs[r][0][i] for r, i, _ in order]
        assert strings == sorted(s for run in runs for s in run[0])
        assert [n for _, _, n in order[1:]] == [suffixes.shared(a, b) for a, b in zip(strings, strings[1:])]
    assert list(suffixes.merged([])) == [] and list(suffixes.merged([([], [])])) == []


def test_front_coding_comes_back():
    strings = sorted([b"", b"a", b"ab", b"abc", b"abd", b"b", b"b"])
    assert suffixes.decoded(*suffixes.front_coded(strings)) == strings


def test_equal_windows_have_anchors_at_equal_offsets():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 600).astype(np.uint8)
    data[300:420] = data[50:170]
    found = suffixes.Anchors(as_texts(pa.array([data.tobytes().decode()])), 64)
    offsets = {int(a - o): int(o) for a, lo, hi in zip(found.at, found.low, found.high) for o in range(lo, hi + 1)}
    assert sorted(offsets) == list(range(600 - 64 + 1))
    assert all(offsets[50 + i] == offsets[300 + i] for i in range(120 - 64 + 1))
