"""Importance resampling towards a target distribution of hashed n-grams.

A document's features are its runs of one to three words, hashed into buckets.
How much likelier a bucket is in the target texts than in all documents gives
the bucket a gain, a whole number. A document weighs the sum of the gains of
its features, and the draw takes the highest weights with Gumbel noise added.

Weights are found by bit-sliced aggregation. Bit k of a document's counts of
all buckets is one plane of as many bits as there are buckets, and bit j of
all positive (or of all negative) gains is another. Two planes and-ed hold a
bit where count times gain has 2 ** (j + k), so population counts times powers
of two sum up to the exact weight.

A task takes text in pieces of a few megabytes, long texts cut between words:
beside the text itself it holds some tens of bytes per byte of a piece. What
is gathered is a number per bucket, from each task and in the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.ranks import ranked
from basketflow.llm.texts import SLICE_BYTES, Texts, slices
from basketflow.session import stored

BUCKETS = 10_000
LONGEST_RUN = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42

# Bytes of words, once A-Z are lower: 0-9, a-z, and all of other scripts.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


class Checksums:
    """CRC-32 of many strings at once. A checksum is linear in the string's
    bits: that of a string with another behind it is its own, advanced by the
    other's length in zero bytes, xor the other's."""

    SHORT = 64

    def __init__(self) -> None:
        row = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            row = np.where(row & 1, (row >> np.uint32(1)) ^ np.uint32(0xEDB88320), row >> np.uint32(1))
        self.table = row.astype(np.uint32)
        # By length below SHORT and byte of the checksum, what each value becomes.
        steps = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])]
        for _ in range(self.SHORT):
            steps.append(self.table[steps[-1] & np.uint32(255)] ^ (steps[-1] >> np.uint32(8)))
        self.short = np.concatenate(steps[:-1]).ravel()
        self.doubling = [steps[-1]]

    @staticmethod
    def _bytes(crc: np.ndarray) -> list[np.ndarray]:
        return [((crc >> np.uint32(8 * j)) & np.uint32(255)).astype(np.int64) for j in range(4)]

    def _apply(self, tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
        a, b, c, d = self._bytes(crc)
        return tables[0][a] ^ tables[1][b] ^ tables[2][c] ^ tables[3][d]

    def advance(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        base = (lengths % self.SHORT) * 1024
        parts = [self.short[base + 256 * j + byte] for j, byte in enumerate(self._bytes(crc))]
        out = parts[0] ^ parts[1] ^ parts[2] ^ parts[3]
        rest = lengths // self.SHORT
        for j in range(int(rest.max(initial=0)).bit_length()):
            if j == len(self.doubling):
                last = self.doubling[-1]
                self.doubling.append(np.stack([self._apply(last, column) for column in last]))
            at = np.flatnonzero((rest >> j) & 1)
            out[at] = self._apply(self.doubling[j], out[at])
        return out

    def followed(self, crc: np.ndarray, other: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of the strings of `crc`, each with one of `other` behind it."""
        return self.advance(crc, lengths) ^ other

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of data[start:end] each: byte after byte of all, longest first."""
        lengths = end - start
        order = np.argsort(-lengths, kind="stable")
        long = int(np.searchsorted(-lengths[order], -self.SHORT))
        crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
        at, many = start[order], np.searchsorted(-lengths[order], -np.arange(self.SHORT))
        for i, n in enumerate(many):
            if n == long:
                break
            byte = data[at[long:n] + i]
            crc[long:n] = self.table[(crc[long:n] ^ byte) & np.uint32(255)] ^ (crc[long:n] >> np.uint32(8))
        out = np.empty_like(crc)
        out[order] = crc ^ np.uint32(0xFFFFFFFF)
        for i in order[:long]:
            out[i] = zlib.crc32(data[start[i] : end[i]])
        return out


def pieces(texts: Texts, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of the bytes, longer than `limit` only by the rest of a word.
    Only a single text may be longer, so none is cut at another's border."""
    start, size = 0, len(texts.data)
    while start < size:
        end = min(size, start + limit) if len(texts) == 1 else size
        while end < size and _INSIDE[texts.data[end]]:
            stop = np.flatnonzero(~_INSIDE[texts.data[end : end + 65536]])
            end = end + int(stop[0]) if stop.size else min(size, end + 65536)
        yield start, end
        start = end


def word_runs(
    texts: Texts, checksums: Checksums, limit: int = SLICE_BYTES
) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """Per piece: the document of each word, and for each length of run the
    documents and checksums of the runs that end in the piece. The last words
    of a piece go before the next."""
    space = np.uint32(zlib.crc32(b" "))
    crc, length, doc = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in pieces(texts, limit):
        data = _LOWER[texts.data[a:b]]
        inside = _INSIDE[data]
        starts_text = np.zeros(b - a + 1, bool)
        bounds = texts.offsets[(texts.offsets >= a) & (texts.offsets <= b)] - a
        starts_text[bounds] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | starts_text[1:-1]
        ends[:-1] &= ~inside[1:] | starts_text[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        kept = min(len(crc), LONGEST_RUN - 1)
        crc = np.concatenate([crc[len(crc) - kept :], checksums.of(data, start, end)])
        length = np.concatenate([length[len(length) - kept :], end - start])
        doc = np.concatenate([doc[len(doc) - kept :], np.searchsorted(texts.offsets[1:], start + a, side="right")])
        run, docs, found = crc, [], []
        for n in range(1, LONGEST_RUN + 1):
            if n > 1:  # the run one shorter that ends a word before, and this word
                spaced = checksums.followed(run[:-1], space, np.ones(max(0, len(run) - 1), np.int64))
                run = np.concatenate([run[:1], checksums.followed(spaced, crc[1:], length[1:])])
            last = np.arange(max(kept, n - 1), len(crc))
            last = last[doc[last - n + 1] == doc[last]]
            docs.append(doc[last])
            found.append(run[last])
        yield doc[kept:], docs, found


def _counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts in all parts."""
    if len(parts) < 2:
        return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return keys, counts


def bucket_sums(texts: DataFrame, buckets: int = BUCKETS, limit: int = SLICE_BYTES) -> list[int]:
    """How many features of all `texts` fall into each bucket. A task sends
    one number per bucket, and the driver holds one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums, sums = Checksums(), np.zeros(buckets, np.int64)
        for _, part in slices(batches):
            for _, _, found in word_runs(part, checksums, limit):
                for run in found:
                    sums += np.bincount(run % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Per bucket, a thousand times the logarithm of how much likelier it is
    in the target, each bucket counted once more than it was found."""
    buckets, s_all, t_all = len(source), sum(source), sum(target)
    return [
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source, target)
    ]


def planes(values: np.ndarray) -> np.ndarray:
    """Bit j of all values as row j, 64 values to a word."""
    words = -(-len(values) // 64)
    bits = np.zeros((int(values.max(initial=0)).bit_length(), words * 64), np.uint8)
    for j in range(len(bits)):
        bits[j, : len(values)] = (values >> j) & 1
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(bits), words)


def weigh(
    key: np.ndarray, counts: np.ndarray, documents: int, buckets: int, signed: list[tuple[int, np.ndarray]]
) -> np.ndarray:
    """The weight of each document, from its counts by document * buckets +
    bucket, in order of that, and the planes of the gains by sign."""
    weight, words = np.zeros(documents, np.int64), -(-buckets // 64)
    for k in range(int(counts.max(initial=0)).bit_length()):
        doc, bucket = np.divmod(key[(counts >> k) & 1 == 1], buckets)
        if not len(doc):
            continue
        with_bit, row = np.unique(doc, return_inverse=True)
        plane = np.zeros(len(with_bit) * words, np.uint64)
        word = row * words + bucket // 64
        first = np.flatnonzero(np.diff(word, prepend=-1))
        plane[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (bucket % 64).astype(np.uint64), first)
        plane = plane.reshape(len(with_bit), words)
        for sign, gain in signed:
            for j, bits in enumerate(gain):
                common = np.bitwise_count(plane & bits).sum(axis=1, dtype=np.int64)
                weight[with_bit] += sign * (common << (j + k))
    return weight


def weights(documents: DataFrame, gain: list[int], limit: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    whole = np.array(gain, np.int64)
    buckets = len(whole)
    signed = [(1, planes(np.maximum(whole, 0))), (-1, planes(np.maximum(-whole, 0)))]
    names = ["doc_id", "n_words", "n_features", "weight"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums = Checksums()
        for batch, part in slices(batches):
            n = len(part)
            n_words, n_features, parts = np.zeros(n, np.int64), np.zeros(n, np.int64), []
            for words, docs, found in word_runs(part, checksums, limit):
                n_words += np.bincount(words, minlength=n)
                at = np.concatenate(docs)
                n_features += np.bincount(at, minlength=n)
                bucket = np.concatenate(found) % np.uint32(buckets)
                parts.append(np.unique(at * buckets + bucket, return_counts=True))
            weight = weigh(*_counts(parts), n, buckets, signed)
            columns = [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = documents.select(F.col("doc_id").cast("bigint"), "text")
    return chosen.mapInArrow(work, ", ".join(f"{name} bigint" for name in names))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A whole number drawn from a Gumbel distribution, in thousandths, by id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("bigint")


def resample(
    documents: DataFrame,
    targets: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    Of the documents with `least_words` words, `percent` in a hundred of the
    highest scores are drawn and ranked from 1, ties to the smaller id, null
    last; `rank` is null for all others. A null text is empty, and has weight
    0. A null id counts as empty text in the noise. Rows that share an id share
    their noise and are drawn row by row. Without targets all buckets are as
    likely there; without documents there are no rows."""
    gain = gains(bucket_sums(documents, buckets, limit), bucket_sums(targets, buckets, limit))
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    rows = stored(weights(documents, gain, limit).withColumn("score", score), "weights")
    fit = F.col("n_words") >= least_words
    drawn = percent * rows.filter(fit).count() // 100
    placed = ranked(rows.filter(fit), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    with_rank = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return with_rank.unionByName(rows.filter(~fit).withColumn("rank", F.lit(None).cast("bigint")))
