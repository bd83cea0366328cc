"""Perplexity under an interpolated modified Kneser-Ney model of word pairs.

Counting is two exchanges of packed numbers: words by hash, then pairs of word
numbers. Each bucket writes its sorted array of keys, and the counts (in as many
bytes as the largest needs), to the shared folder; the counts that smoothing needs (how many different words
follow a word how often, how many precede it) are exchanged by word number and
written into arrays of one slot per word. Workers map these files into memory
and search them, so a worker reads only the pages its texts touch.

The shared folder, spark.checkpoint.dir, must be mounted on all executors for
that (a `file:` path), which is checked.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.packed import (
    ARROW,
    COLUMNS,
    SCHEMA,
    Ranges,
    gather,
    grouped,
    pieces,
    refined,
    text_bytes,
)
from basketflow.llm.texts import Texts, mix, slices
from basketflow.session import scratch

# The token after the last word. Its hash is fixed; it is no word's text.
END = np.uint64(0x0E0FD0CE57EAD001)
COUNT_SLICE = 4 << 20
BYTES_PER_WORD = 6
RANGE_BITS = 18
# Up to so many words, a pair is one number of 64 bits; beyond, 16 bytes.
NARROW = 1 << 32
# Shares of text bytes that reach an exchange as distinct entries of a slice.
WORD_SHARE, PAIR_SHARE = 0.25, 0.75


def mounted(path: str) -> str:
    """A folder path as the operating system knows it."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path or path.startswith("hdfs:"):
        raise ValueError(f"{path} cannot be memory-mapped: set spark.checkpoint.dir to a mounted folder")
    return path


def save(path: str, values: np.ndarray) -> None:
    """Write whole or not at all; a task that runs again writes the same."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{os.getpid()}.tmp"
    values.tofile(own)
    os.replace(own, path)


def narrowest(counts: np.ndarray) -> np.ndarray:
    """The counts in the least width that holds them all."""
    return counts.astype(np.min_scalar_type(int(counts.max()))) if len(counts) else counts


def load(path: str, kind: type | str) -> np.ndarray:
    size = os.path.getsize(path) // np.dtype(kind).itemsize if os.path.exists(path) else 0
    return np.memmap(path, kind, "r", shape=(size,)) if size else np.zeros(0, kind)


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document of each) of all words and an end after each text."""
    words = texts.words(lower=True)
    hashes = np.insert(words.hashes, words.bounds[1:], END)
    documents = np.insert(words.documents(), words.bounds[1:], np.arange(len(texts)))
    return hashes, documents


def find(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Where each key is in an ascending array, -1 if it is not."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class Model:
    """Paths and totals of a counted model. Arrays open when first used, on
    the worker; only this small record travels."""

    folder: str
    words: Ranges
    pairs: Ranges
    narrow: int = NARROW
    first: np.ndarray | None = None  # number of the first word of each bucket
    vocabulary: int = 0
    total: int = 0
    documents: int = 0
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    more_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    distinct_pairs: int = 0
    spare: float = 1.0  # what the lower level leaves to words never seen
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_open": {}}

    def array(self, name: str, kind: type) -> np.ndarray:
        if name not in self._open:
            self._open[name] = load(f"{self.folder}/{name}", kind)
        return self._open[name]

    def counts(self, name: str, length: int) -> np.ndarray:
        """A `narrowest` array of so many counts; none if there is no file."""
        if name not in self._open:
            path = f"{self.folder}/{name}"
            width = os.path.getsize(path) // length if os.path.exists(path) else 1
            self._open[name] = load(path, f"u{width}")
        return self._open[name]

    @property
    def wide(self) -> bool:
        return self.vocabulary >= self.narrow

    def _search(self, kind: str, keys: np.ndarray, bucket: np.ndarray) -> Iterator[tuple]:
        """(bucket, positions of keys, their places in its array, the array's
        length) for each bucket."""
        order = np.lexsort((keys, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for a, z in zip(cuts, np.append(cuts[1:], len(order))):
            b, at = bucket[order[a]], order[a:z]
            held = self.array(f"{kind}/{b}.keys", keys.dtype.str)
            yield b, at, find(keys[at], held), len(held)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of words, -1 and 0 if unknown."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for b, at, place, _ in self._search("words", hashes, self.words.fine(hashes)):
            known = place >= 0
            number[at[known]] = self.first[b] + place[known]
            count[at[known]] = self.array(f"words/{b}.counts", np.int64)[place[known]]
        return number, count

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        count = np.zeros(len(pairs), np.int64)
        for b, at, place, length in self._search("pairs", pairs, self.pairs.fine(_hashed(pairs))):
            known = place >= 0
            if known.any():
                count[at[known]] = self.counts(f"pairs/{b}.counts", length)[place[known]]
        return count


def _grouped(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def count_words(documents: DataFrame, model: Model) -> Model:
    ranges, kinds = model.words, [np.uint64, np.int64]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, limit=COUNT_SLICE):
            keys, counts = np.unique(tokens(texts)[0], return_counts=True)
            yield from pieces(ranges.first(keys), [keys, counts.astype(np.int64)])

    def again(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = _grouped(keys, counts)
        yield from pieces(ranges.fine(keys), [keys, counts])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _grouped(*gather(rows, kinds))
        b = int(rows["bucket"].iloc[0])
        save(f"{model.folder}/words/{b}.keys", keys)
        save(f"{model.folder}/words/{b}.counts", counts)
        at = find(np.array([END]), keys)[0]
        ends = int(counts[at]) if at >= 0 else 0
        return pd.DataFrame({"b": [b], "distinct": [len(keys)], "total": [int(counts.sum())], "ends": [ends]})

    exchanged = documents.select("text").mapInArrow(local, SCHEMA)
    if ranges.deep:
        exchanged = refined(exchanged, ranges, kinds, again)
    done = grouped(exchanged, ranges).applyInPandas(merge, "b bigint, distinct bigint, total bigint, ends bigint")
    sizes = done.toPandas()  # one row per bucket of some 400,000 entries
    distinct = np.zeros(1 << ranges.bits, np.int64)
    distinct[sizes["b"].to_numpy(np.int64)] = sizes["distinct"].to_numpy(np.int64)
    model.first = np.concatenate([[0], np.cumsum(distinct)[:-1]])
    model.vocabulary, model.total = int(distinct.sum()), int(sizes["total"].sum())
    model.documents = int(sizes["ends"].sum())
    return model


def _pairs(model: Model, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word, count of word, document) as word numbers, for all
    tokens; before the first word stands the number past the vocabulary."""
    hashes, documents = tokens(texts)
    words, back = np.unique(hashes, return_inverse=True)
    number, count = model.numbers(words)
    after, count = number[back], count[back]
    before = np.concatenate([[model.vocabulary], after[:-1]])
    before[np.concatenate([[True], documents[1:] != documents[:-1]])] = model.vocabulary
    return before, after, count, documents


def _joined(before: np.ndarray, after: np.ndarray, wide: bool) -> np.ndarray:
    """Pairs of word numbers as one array, in the order of both."""
    if not wide:
        return (before.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
    return np.stack([before, after], axis=1).astype(">u8").view("S16").reshape(-1)


def _parts(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, after) of pairs."""
    if pairs.dtype == np.uint64:
        return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    both = np.ascontiguousarray(pairs).view(">u8").reshape(-1, 2).astype(np.int64)
    return both[:, 0], both[:, 1]


def _hashed(pairs: np.ndarray) -> np.ndarray:
    if pairs.dtype == np.uint64:
        return mix(pairs)
    before, after = (x.astype(np.uint64) for x in _parts(pairs))
    return mix(mix(before) ^ after)


def _times(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def discounts(times: list[int]) -> tuple[float, float, float]:
    """What modified Kneser-Ney takes off counts of 1, 2 and more."""
    n1, n2, n3, n4 = times
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(np.clip(d, 0.05, k)) for d, k in zip(found, (1, 2, 3)))


def count_pairs(documents: DataFrame, model: Model) -> Model:
    """Write the pairs, and per word how it is followed and preceded."""
    ranges, wide = model.pairs, model.wide
    kinds = [np.int64, np.int64, np.int64] if wide else [np.uint64, np.int64]

    def sent(deal, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = deal(_hashed(keys))
        order = np.lexsort((keys, bucket))
        columns = [c[order] for c in (*(_parts(keys) if wide else [keys]), counts)]
        yield from pieces(bucket[order], columns)

    def received(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return _grouped(_joined(*columns[:2], wide) if wide else columns[0], columns[-1])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, limit=COUNT_SLICE):
            before, after, _, _ = _pairs(model, texts)
            keys, counts = np.unique(_joined(before, after, wide), return_counts=True)
            yield from sent(ranges.first, keys, counts.astype(np.int64))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = received(gather(rows, kinds))
        b = int(rows["bucket"].iloc[0])
        save(f"{model.folder}/pairs/{b}.keys", keys)
        save(f"{model.folder}/pairs/{b}.counts", narrowest(counts))
        before, after = _parts(keys)
        ways = np.minimum(counts, 3).astype(np.int64) - 1
        code, followed = np.unique(before * 4 + ways, return_counts=True)
        last, preceded = np.unique(after * 4 + 3, return_counts=True)
        codes, values = np.concatenate([code, last]), np.concatenate([followed, preceded]).astype(np.int64)
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        out = [x.to_pandas() for x in pieces(codes >> (RANGE_BITS + 2), [codes, values])]
        times = pa.array([np.array([*_times(counts), len(keys)], np.int64).tobytes()], pa.binary())
        none = [pa.nulls(1, pa.binary())] * (COLUMNS - 1)
        head = pa.RecordBatch.from_arrays([pa.array([-1 - b]), pa.array([1], pa.int32()), times, *none], schema=ARROW)
        return pd.concat([head.to_pandas(), *out])

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        b = int(rows["bucket"].iloc[0])
        if b < 0:  # the totals of a bucket of pairs
            totals = [np.frombuffer(blob, np.int64) for blob in rows["c0"]]
            return pd.DataFrame([[0, *np.sum(totals, axis=0).tolist(), 0]], columns=columns)
        codes, values = gather(rows, [np.int64, np.int64])
        table = np.zeros(4 << RANGE_BITS, np.int64)
        np.add.at(table, codes - (b << (RANGE_BITS + 2)), values)
        save(f"{model.folder}/ways/{b}", narrowest(table))
        preceded = table[3::4]
        words = int((preceded > 0).sum())
        return pd.DataFrame([[1, *_times(preceded), int(preceded.sum()), words]], columns=columns)

    columns = ["level", "n1", "n2", "n3", "n4", "total", "words"]
    exchanged = documents.select("text").mapInArrow(local, SCHEMA)
    if ranges.deep:
        exchanged = refined(exchanged, ranges, kinds, lambda *c: sent(ranges.fine, *received(list(c))))
    merged = grouped(exchanged, ranges).applyInPandas(merge, SCHEMA)
    done = merged.groupBy("bucket").applyInPandas(spread, ", ".join(f"{c} bigint" for c in columns))
    table = done.groupBy("level").agg(*(F.sum(c).alias(c) for c in columns[1:])).toPandas().set_index("level")
    if 0 in table.index:
        model.discounts = discounts([int(table.loc[0, f"n{k}"]) for k in (1, 2, 3, 4)])
        model.more_discounts = discounts([int(table.loc[1, f"n{k}"]) for k in (1, 2, 3, 4)])
        model.distinct_pairs = int(table.loc[0, "total"])
        ways = [int(table.loc[1, f"n{k}"]) for k in (1, 2)]
        ways.append(int(table.loc[1, "words"]) - sum(ways))
        model.spare = float(np.dot(ways, model.more_discounts)) / model.distinct_pairs
    return model


def fit(documents: DataFrame, ranges: tuple[Ranges, Ranges] | None = None, narrow: int = NARROW) -> Model:
    """Count the words and pairs of all `documents`. The `ranges` of both follow
    from the bytes of text unless given."""
    folder = mounted(scratch(documents.sparkSession, "ngrams"))
    if not ranges:
        words = text_bytes(documents) // BYTES_PER_WORD
        ranges = Ranges(int(words * WORD_SHARE)), Ranges(int(words * PAIR_SHARE))
    return count_pairs(documents, count_words(documents, Model(folder, *ranges, narrow)))


def _ways(model: Model, numbers: np.ndarray) -> np.ndarray:
    """For each word number the four counts: followed once, twice, more often,
    and preceded; zeros for -1."""
    out = np.zeros((len(numbers), 4), np.float64)
    block = numbers >> RANGE_BITS
    for b in np.unique(block[numbers >= 0]):
        at = np.flatnonzero(block == b)
        table = model.counts(f"ways/{b}", 4 << RANGE_BITS)
        if len(table):
            out[at] = table.reshape(-1, 4)[numbers[at] - (b << RANGE_BITS)]
    return out


def probabilities(model: Model, before: np.ndarray, after: np.ndarray, before_count: np.ndarray) -> np.ndarray:
    """P(after | before) of word numbers; -1 is a word not in training."""
    preceded = _ways(model, after)[:, 3]
    d = np.array([0.0, *model.more_discounts])
    uniform = 1.0 / (model.vocabulary + 1)
    if not model.distinct_pairs:
        return np.full(len(after), uniform)
    p = np.maximum(preceded - d[np.minimum(preceded, 3).astype(int)], 0) / model.distinct_pairs
    p += model.spare * uniform
    followed = _ways(model, before)[:, :3]
    known = np.flatnonzero((before >= 0) & (before_count > 0))
    weight = followed[known] @ np.array(model.discounts) / before_count[known]
    seen = np.zeros(len(known))
    both = np.flatnonzero(after[known] >= 0)
    at = known[both]
    seen[both] = model.pair_counts(_joined(before[at], after[at], model.wide))
    d = np.array([0.0, *model.discounts])
    p[known] = np.maximum(seen - d[np.minimum(seen, 3).astype(int)], 0) / before_count[known] + weight * p[known]
    return p


def score(documents: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document; a null or empty text is its end alone."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            before, after, count, rows = _pairs(model, texts)
            before_count = np.concatenate([[0], count[:-1]])
            before_count[before == model.vocabulary] = model.documents
            # Each pair of words once; its context count goes with its first word.
            both = _joined(before + 1, after + 1, model.wide)
            _, first, back = np.unique(both, return_index=True, return_inverse=True)
            p = probabilities(model, before[first], after[first], before_count[first])
            p = np.log10(p)[back]
            base = np.log10((count + 1) / (model.total + model.vocabulary + 1))
            n = len(texts)
            total = lambda x: np.bincount(rows, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(np.bincount(rows, minlength=n)),
                    pa.array(total(count > 0).astype(np.int64)),
                    pa.array(np.full(n, model.total)),
                    pa.array(total(base)),
                    pa.array(total(p)),
                ],
                names=names,
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), "text", held_out.alias("held_out"))
    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """A null id is in no fold, so its text is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def perplexities(
    documents: DataFrame, ranges: tuple[Ranges, Ranges] | None = None, narrow: int = NARROW
) -> DataFrame:
    """Learn from the documents outside the fold, score all of them. A task
    holds some tens of bytes for each byte of the longest text."""
    model = fit(documents.filter(~held_out()), ranges, narrow)
    return score(documents, model, held_out())
