"""Benchmark items in documents, up to a number of changed words.

An item of n words may differ by k = n // 8 words (put in, left out or
changed). Cut into k + 1 pieces, one of them must then stand in the document
as it is. Pieces are found by rolling hashes of the document's words, one pass
per piece length; around each hit Myers' bit-parallel distance, over words,
tells how near the item comes. Case, punctuation and white space do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.texts import Texts, Words, slices

WORDS_PER_ERROR = 8
# Items are sent to all tasks in blocks of at most so many bytes of text.
BLOCK_BYTES = 8 << 20

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20


def plain(texts: Texts) -> Words:
    """Lower-case words without ASCII punctuation."""
    return Texts(_PLAIN[texts.data], texts.offsets).words(lower=True)


@dataclass(frozen=True)
class Item:
    item_id: int
    words: np.ndarray
    errors: int


class Items:
    """Items with their pieces by length: sorted hashes and, for each, the
    item and where in it the piece begins."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.items: list[Item] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            words = plain(Texts(data, np.array([0, len(data)])))
            n = len(words)
            if not n:
                continue
            errors = n // WORDS_PER_ERROR
            cuts = np.arange(errors + 2) * n // (errors + 1)
            hashes = words.rolling().hash(cuts[:-1], cuts[1:])
            for h, a, b in zip(hashes.tolist(), cuts, cuts[1:]):
                found.setdefault(int(b - a), []).append((h, len(self.items), int(a)))
            self.items.append(Item(item_id, words.hashes, errors))
        self.pieces = {}
        for length, rows_ in sorted(found.items()):
            rows_.sort()
            hashes = np.array([r[0] for r in rows_], np.uint64)
            table = np.zeros(1 << 20, bool)
            table[(hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.pieces[length] = (hashes, np.array([r[1:] for r in rows_], np.int64), table)


def distance(item: np.ndarray, words: np.ndarray, limit: int) -> tuple[int, int]:
    """(distance, end): the smallest edit distance between `item` and any run
    of `words`, and the first place where such a run ends; (limit + 1, 0) if
    all are farther. Bit i of each word stands for the item's word i."""
    m = len(item)
    places: dict[int, int] = {}
    for i, h in enumerate(item.tolist()):
        places[h] = places.get(h, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, least, end = full, 0, m, limit + 1, 0
    for j, h in enumerate(words.tolist()):
        eq = places.get(h, 0)
        across = eq | minus
        down = (((eq & plus) + plus) ^ plus) | eq
        up_h, down_h = minus | (full & ~(down | plus)), plus & down
        score += bool(up_h & top) - bool(down_h & top)
        up_h, down_h = (up_h << 1) & full, (down_h << 1) & full
        plus = down_h | (full & ~(across | up_h))
        minus = up_h & across
        if score < least:
            least, end = score, j + 1
    return least, end


def matches(texts: Texts, items: Items) -> list[dict[int, int]]:
    """For each text, the items found in it and their smallest distance."""
    words = plain(texts)
    rolling, documents = words.rolling(), words.documents()
    last = words.bounds[1:][documents] if len(words) else documents
    position = np.arange(len(words))
    around: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for length, (hashes, owners, table) in items.pieces.items():
        at = np.flatnonzero(position + length <= last)
        h = rolling.hash(at, at + length)
        near = np.flatnonzero(table[(h & np.uint64(0xFFFFF)).astype(np.int64)])
        at, h = at[near], h[near]
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        for i in np.flatnonzero(high > low):
            for item, begins in owners[low[i] : high[i]].tolist():
                size, errors = len(items.items[item].words), items.items[item].errors
                d = int(documents[at[i]])
                first = max(int(words.bounds[d]), int(at[i]) - begins - errors)
                until = min(int(words.bounds[d + 1]), int(at[i]) - begins + size + errors)
                around.setdefault((d, item), []).append((first, until))
    found: list[dict[int, int]] = [{} for _ in range(len(texts))]
    for (d, number), spans in around.items():
        item = items.items[number]
        spans.sort()
        merged = [list(spans[0])]
        for a, b in spans[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        least = min(distance(item.words, words.hashes[a:b], item.errors)[0] for a, b in merged)
        if least <= item.errors:
            found[d][item.item_id] = min(least, found[d].get(item.item_id, least))
    return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, fetched one partition at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def found_items(documents: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns with `found`, an array of (item_id, distance) by item.

    Documents are passed once for every block of items, each pass adding to
    the array, so the items sent at a time are bounded."""
    spark = documents.sparkSession
    kind = "array<struct<item_id:bigint,distance:bigint>>"
    out = documents.withColumn("found", F.array().cast(kind))
    fields = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64())]))
    for block in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)
        columns = list(dict.fromkeys([*keep, "text", "found"]))
        schema = out.select(*columns).schema

        def run(batches: Iterator[pa.RecordBatch], sent=sent, columns=columns) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value)
            for part, texts in slices(batches):
                before = part.column("found").to_pylist()
                now = [
                    [*old, *({"item_id": i, "distance": n} for i, n in new.items())]
                    for old, new in zip(before, matches(texts, items))
                ]
                arrays = [pa.array(now, fields) if c == "found" else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

        out = out.select(*columns).mapInArrow(run, schema)
    return out.select(*keep, F.array_sort("found").alias("found"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, item_ids, distances) of every document. Null and
    empty texts hold no item, and items without a word are in no document;
    rows that repeat are judged each. Items of equal id count as one in a block
    of items; those without id as one more, first in `item_ids` as a null."""
    found = found_items(documents, benchmark, ["doc_id"])
    items = F.transform("found", lambda x: x["item_id"])
    return found.select(
        "doc_id",
        (F.size("found") > 0).alias("contaminated"),
        items.alias("item_ids"),
        F.transform("found", lambda x: x["distance"]).alias("distances"),
    )
