"""Packing documents into windows of tokens by non-negative least squares.

Each document is its token ids and an end id, cut every `WINDOW` ids. Whole
windows stand alone. For the rests only their lengths matter: combinations of
two and three lengths that fill a window exactly are enumerated, repeat counts
that reproduce the histogram of lengths are solved for, rounded down, and what
is left is packed greedily. The histogram has under `WINDOW` entries whatever
the number of documents, so the solving is driver work of fixed size; which
rest goes where is looked up by its number among rests of its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.sharding import numbered
from basketflow.llm.texts import slices
from basketflow.session import stored

WINDOW = 1024
END_ID = 0
TRIPLES_PER_LENGTH = 12
_BEYOND_LATIN = re.compile("[^\u0000-ɏ]")


class Tokenizer:
    """Ids of a byte-level BPE vocabulary.

    The rank file and the JSON file hold one vocabulary; the first is faster
    by a factor of five. Texts beyond the Latin blocks, where the two libraries
    could hold different Unicode tables, and texts with a special token's name
    go to the JSON file's own library, which defines the ids.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer as FromJson

        self.exact = FromJson.from_file(json_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text or _BEYOND_LATIN.search(text):
            found = self.exact.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END_ID], "<u4")


_loaded: dict[str, Tokenizer] = {}


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers

    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(documents: DataFrame, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Every document cut into pieces of WINDOW ids and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        where = paths or default_paths()
        if where[0] not in _loaded:
            _loaded[where[0]] = Tokenizer(*where)
        tokenizer = _loaded[where[0]]
        for part, texts in slices(batches):
            rows: list[tuple] = []
            for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                ids = tokenizer.ids(texts.text(i).decode("utf-8", "replace"))
                for start in range(0, len(ids), WINDOW):
                    piece = ids[start : start + WINDOW]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Pattern:
    """Lengths that share a window, and how many windows are filled so."""

    lengths: tuple[int, ...]
    windows: int


def combinations(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Pairs, and a spread of triples, of present lengths that fill a window."""
    present = np.flatnonzero(counts)
    have = set(present.tolist())
    found = {tuple(sorted((a, window - a))) for a in have if window - a in have}
    for a in present.tolist():
        others = present[present <= window - a - 1]
        for b in others[:: max(1, len(others) // TRIPLES_PER_LENGTH)].tolist():
            if window - a - b in have:
                found.add(tuple(sorted((a, b, window - a - b))))
    return sorted(found)


def solve(combos: list[tuple[int, ...]], counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring (lengths used by x) close to `counts`:
    min |Ax - counts|^2 by multiplicative updates, which keep x from going
    below zero (A and counts have no negative entries)."""
    row = np.concatenate([np.array(c, np.int64) for c in combos])
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    used = lambda x: np.bincount(row, weights=x[column], minlength=len(counts))
    onto = lambda r: np.bincount(column, weights=r[row], minlength=len(combos))
    x, target = np.full(len(combos), counts.sum() / max(1, len(row))), onto(counts.astype(float))
    for _ in range(steps):
        x *= target / np.maximum(onto(used(x)), 1e-12)
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[Pattern]:
    """Patterns that use up a histogram of lengths, exactly."""
    left = counts.astype(np.int64).copy()
    patterns: list[Pattern] = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        kinds, times = np.unique(lengths, return_counts=True)
        windows = int(min(most, *(left[kinds] // times)))
        if windows > 0:
            left[kinds] -= windows * times
            patterns.append(Pattern(lengths, windows))

    combos = combinations(counts, window)
    if combos:
        repeats = solve(combos, counts)
        for i in np.argsort(-repeats, kind="stable"):
            take(combos[i], int(repeats[i]))
    while (present := np.flatnonzero(left)).size:
        lengths, trial = [int(present[-1])], left.copy()
        trial[lengths[0]] -= 1
        while gap := window - sum(lengths):
            fits = np.flatnonzero(trial[: gap + 1])
            if not fits.size:
                break
            pair = fits[(fits <= gap - fits) & (trial[gap - fits] > (fits == gap - fits))] if trial[gap] == 0 else []
            chosen = int(gap - pair[0]) if len(pair) else int(fits[-1])
            lengths.append(chosen)
            trial[chosen] -= 1
        take(tuple(lengths), 1 << 62)
    return patterns


def layout(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: from which number on (sorted) its pieces go to which
    first sequence, at which offset."""
    lists: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            first = taken.get(length, 0)
            lists.setdefault(length, []).append((first, sequence - first, offset))
            taken[length] = first + pattern.windows
            offset += length
        sequence += pattern.windows
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in lists.items()}


def pack(documents: DataFrame, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset). A null or empty text is its end id alone; rows that
    repeat are packed each; an empty table gives no rows."""
    cut = stored(pieces(documents, paths).withColumn("tie", F.monotonically_increasing_id()), "pieces")
    # At most one entry for each length.
    histogram = cut.groupBy("length").count().toPandas()
    counts = np.zeros(WINDOW + 1, np.int64)
    counts[histogram["length"].to_numpy(np.int64)] = histogram["count"].to_numpy(np.int64)
    whole, counts[WINDOW] = int(counts[WINDOW]), 0
    patterns = [*([Pattern((WINDOW,), whole)] if whole else []), *plan(counts)]
    where = layout(patterns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                first, shift, begin = where[int(length)]
                entry = np.searchsorted(first, numbers[at], side="right") - 1
                sequence[at], offset[at] = numbers[at] + shift[entry], begin[entry]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            kept = [batch.column(name) for name in names[:5]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    ranked = numbered(cut, ["doc_id", "start", "tie"], by=["length"])
    return ranked.drop("tie").mapInArrow(place, PIECES + ", sequence_id bigint, offset bigint")
