"""Repeated byte strings, by a distributed merge sort of suffixes.

Sorting all suffixes of all texts would move every text hundreds of times, so
suffixes are sorted from anchors only. An anchor is the smallest hash of the
GRAM-byte strings inside some `size`-byte window (a minimizer): equal windows
have their anchor at the same offset, so two windows are equal if and only if
the texts agree around their anchors, far enough to the left and to the right.

1. Anchors whose gram stands only once are dropped (an exchange of hashes).
2. The others carry their surroundings: the bytes from the anchor on (the
   suffix) and those before it, as far as their windows reach. In a task,
   anchors with the same surroundings are one entry.
3. Each task sorts its entries into runs, front-coded: a suffix is the length
   of the prefix it shares with the one before, and the rest. The order is by
   the gram's hash and then by the bytes, so equal ranges of hashes are equal
   shares of the work. Runs are dealt by range and merged by a loser tree
   which compares suffixes from the first byte not yet known to agree.
4. In the merged order, agreement to the right is the smallest shared prefix
   in between; the same holds to the left for entries sorted by what precedes
   them. So for each offset, windows are equal if they are in the same class
   on both sides, and classes are runs of the two orders.

Entries of one task that have several owners are repeats already: the places
they cover go straight to their documents, and the range gets the entry with
its count alone. So a passage in very many documents reaches its range once for
each slice of input.

A gram with more than HOT anchors may bring too many different surroundings
into one range. Its range goes by more bytes: the windows of an anchor are cut
into blocks of BLOCK offsets, and a block goes by the hash of the bytes that
all windows of the block hold, nearly `size` of them. Equal windows have equal
offsets, so they meet in one range, where they are sorted and compared like all
others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.packed import (
    ARROW,
    SCHEMA,
    bucket_bits,
    bucket_of,
    gather,
    pack,
    pieces,
    text_bytes,
    unpack,
)
from basketflow.llm.texts import Texts, ids, mix, slices
from basketflow.session import stored

SIZE = 400
GRAM = 32
# Entries of one range that are merged by one task.
RANGE_ENTRIES = 20_000
# Anchors of a hot gram, at least. Where HOT_GRAMS grams could have as many, it
# takes more, so that about 8 MB at most name all hot grams.
HOT = 100_000
HOT_GRAMS = 1 << 20
# Offsets of a block of a hot gram's windows.
BLOCK = 16
# Text of a slice, small enough for its arrays to stay in a processor's cache.
ANCHOR_SLICE = 512 << 10
# A slice that is longer, for a long text, is searched piece by piece, so that
# places in a piece fit the low bits of a hash.
PIECE = 1 << 27
_PLACE = np.uint64((1 << 28) - 1)
_GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)


class Anchors:
    """Anchors of some texts: `at` (byte position), `row` (text), and the
    windows they stand for: those that start `low` to `high` bytes before."""

    def __init__(self, texts: Texts, size: int, gram: int = GRAM, piece: int = PIECE):
        n = len(texts.data)
        span = size - gram + 1  # grams in a window
        last = np.repeat(texts.offsets[1:], np.diff(texts.offsets))
        starts = np.flatnonzero(np.arange(n) + size <= last)  # windows
        self.row = self.at = self.low = self.high = self.key = np.zeros(0, np.int64)
        if not len(starts):
            return
        found, keys = [], []
        for begin in range(0, n, piece):
            here = starts[np.searchsorted(starts, begin) : np.searchsorted(starts, begin + piece)] - begin
            if not len(here):
                continue
            hashes = _gram_hashes(texts.data[begin : begin + piece + size - 1], gram)
            # The leftmost smallest hash of each window: its place is in the low bits.
            best = _sliding_min((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), span)
            best = (best[here] & _PLACE).astype(np.int64)
            found.append(best + begin)
            keys.append(hashes[best])
        best = np.concatenate(found)
        first = np.concatenate([[True], best[1:] != best[:-1]])
        head = np.flatnonzero(first)
        tail = np.append(head[1:], len(best)) - 1
        self.at = best[head]
        self.high, self.low = self.at - starts[head], self.at - starts[tail]
        self.row = np.searchsorted(texts.offsets, self.at, side="right") - 1
        # Anchors are small hashes by choice: spread them out again.
        self.key = mix(np.concatenate(keys)[head])


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes (a multiple of 8) from each place on."""
    n = len(data) - gram + 1
    data = np.ascontiguousarray(data)
    out = np.zeros(n, np.uint64)
    for i in range(0, gram, 8):
        eight = np.ndarray((n,), "<u8", data, offset=i, strides=(1,))
        out ^= eight
        out *= _GRAM_BASE
        out ^= out >> np.uint64(29)
    out *= _GRAM_BASE
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for all i: a window is the end of one block of
    `width` values and the beginning of the next."""
    n = len(values)
    table = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = values
    table = table.reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def _repeats(bits: int, doc_bits: int, keys, doc, at, window) -> Iterator[pa.RecordBatch]:
    """What a slice sends of its (key, place)s: each key once, with its count
    (kind 0), and the places whose key it has more than once (kind 1)."""
    order = np.lexsort((at, doc, keys))
    keys, doc, at, window = keys[order], doc[order], at[order], window[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    head, number = np.flatnonzero(first), np.cumsum(first) - 1
    count = np.diff(np.append(head, len(keys))).astype(np.uint32)
    again = np.flatnonzero(count[number] > 1)
    yield from _by_document(doc_bits, doc[again], at[again], window[again])
    columns = [keys[head], doc[head], at[head], window[head], count]
    yield from pieces(bucket_of(keys[head], bits), columns)


def _by_document(doc_bits: int, doc, at, window) -> Iterator[pa.RecordBatch]:
    bucket = bucket_of(mix(doc.view(np.uint64)), doc_bits)
    order = np.lexsort((at, doc, bucket))
    yield from pieces(bucket[order], [doc[order], at[order], window[order]], kind=1)


PLACE = [np.int64, np.int32, np.uint32]


def _settle(doc_bits: int, hot: int):
    """Of a bucket of keys: the places of keys that stand twice or more
    (kind 1), and the keys that stand more than `hot` times (kind 2)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys, doc, at, window, count = gather(rows, [np.uint64, *PLACE, np.uint32])
        order = np.argsort(keys, kind="stable")
        keys, doc, at, window, count = (x[order] for x in (keys, doc, at, window, count))
        out = [rows[rows["kind"] == 1]]
        if len(keys):
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            head = np.flatnonzero(first)
            total = np.add.reduceat(count.astype(np.int64), head)
            found = np.flatnonzero((total[np.cumsum(first) - 1] > 1) & (count == 1))
            out += [b.to_pandas() for b in _by_document(doc_bits, doc[found], at[found], window[found])]
            many = total > hot
            columns = [keys[head[many]], total[many]]
            out += [b.to_pandas() for b in pieces(np.zeros(many.sum(), np.int64), columns, kind=2)]
        return pd.concat(out)

    return run


def _anchor_rows(documents: DataFrame, size: int, bits: int, doc_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def sent() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            yield from _repeats(bits, doc_bits, *columns)

        for part, texts in slices(batches, limit=ANCHOR_SLICE):
            a = Anchors(texts, size)
            if len(a.at):
                at = (a.at - texts.offsets[a.row]).astype(np.int32)
                window = (a.low | a.high << 16).astype(np.uint32)
                held.append((a.key, ids(part.column("id"))[a.row], at, window))
            if sum(len(h[0]) for h in held) > 1 << 17:
                yield from sent()
        if held:
            yield from sent()

    return documents.mapInArrow(run, SCHEMA)


def _documents_of(rows: DataFrame, names: list[str], kinds: list[type]) -> DataFrame:
    """Kind 1 rows as one row per document: (id, packed arrays), sorted."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        doc, *columns = gather(frame, kinds, kind=1)
        order = np.lexsort((*columns[::-1], doc))
        doc, columns = doc[order], [c[order] for c in columns]
        cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(doc)) if len(doc) else cuts
        packed = {n: [pack(c[a:b]) for a, b in zip(cuts, ends)] for n, c in zip(names, columns)}
        return pd.DataFrame({"id": doc[cuts], **packed})

    schema = ", ".join(["id bigint", *(f"{n} binary" for n in names)])
    return rows.filter("kind = 1").groupBy("bucket").applyInPandas(run, schema)


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of a and b, which agree up to `known`."""
    most, step = min(len(a), len(b)), 32
    while known < most:
        if a[known : known + step] == b[known : known + step]:
            known, step = min(known + step, most), step * 2
        elif step == 1:
            return known
        else:
            step = max(1, step // 4)
    return most


Run = tuple[list[bytes], list[int]]


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place, prefix shared with the one before) of all entries of the
    sorted runs, in order. A run is its strings and, for each, the prefix it
    shares with the one before it.

    In the loser tree each run's head knows how long a prefix it shares with
    the last winner. Of two heads the one that shares more is the smaller;
    only where they share as much are bytes compared, from there on."""
    size = 1 << max(0, len(runs) - 1).bit_length()
    at = [0] * len(runs)
    known = [0] * len(runs)

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        if y < 0 or x < 0:
            return (x, y) if y < 0 else (y, x)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        a, b = runs[x][0][at[x]], runs[y][0][at[y]]
        n = shared(a, b, known[x])
        if a[n:] <= b[n:] if n < len(a) and n < len(b) else len(a) <= len(b):
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    losers = [-1] * size
    level = [i if i < len(runs) and runs[i][0] else -1 for i in range(size)]
    base = size // 2
    while len(level) > 1:
        won = []
        for i in range(0, len(level), 2):
            winner, losers[base + i // 2] = play(level[i], level[i + 1])
            won.append(winner)
        level, base = won, base // 2
    winner = level[0] if level else -1
    while winner >= 0:
        yield winner, at[winner], known[winner]
        x = winner
        at[x] += 1
        strings, prefixes = runs[x]
        known[x] = prefixes[at[x]] if at[x] < len(strings) else 0
        winner = x if at[x] < len(strings) else -1
        node = (size + x) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(prefixes, rests' lengths, rests) of sorted strings."""
    prefixes = [0, *(shared(a, b) for a, b in zip(strings, strings[1:]))]
    rests = [s[n:] for s, n in zip(strings, prefixes)]
    return np.array(prefixes, np.uint16), np.array([len(r) for r in rests], np.uint16), b"".join(rests)


def decoded(prefixes: np.ndarray, lengths: np.ndarray, rests: bytes) -> list[bytes]:
    out, last, start = [], b"", 0
    for n, length in zip(prefixes.tolist(), lengths.tolist()):
        last = last[:n] + rests[start : start + length]
        start += length
        out.append(last)
    return out


_RUN_NAMES = ["bucket", "kind", "prefixes", "lengths", "rests", "lefts", "meta", "owners", "places"]
RUNS = "bucket bigint, kind int, " + ", ".join(f"{name} binary" for name in _RUN_NAMES[2:])


def _blocks(text: bytes, at: int, low: int, high: int, size: int) -> Iterator[tuple[bytes, int, int]]:
    """(key, low, high): the windows of an anchor that start `low` to `high`
    bytes before it, by blocks of BLOCK offsets. The key is a hash of the bytes
    that every window of the block holds, wherever the anchor's own windows end."""
    for begin in range(low - low % BLOCK, high + 1, BLOCK):
        core = text[at - begin : at + size - (begin + BLOCK - 1)]
        key = hashlib.blake2b(core, digest_size=8).digest()
        yield key, max(low, begin), min(high, begin + BLOCK - 1)


Entries = dict[tuple[bytes, bytes, int], list[tuple[int, int]]]


def _entries_of(part: pa.RecordBatch, texts: Texts, size: int, hot: np.ndarray) -> Entries:
    """(key and suffix, bytes before it from the last on, low and high offset)
    of the anchors of some texts, with the places (id, at) of each."""
    entries: Entries = {}
    for i, (own, at, window) in enumerate(zip(*(part.column(c).to_pylist() for c in ("id", "at", "window")))):
        text = texts.text(i)
        at, window = unpack(at, np.int32), unpack(window, np.uint32)
        inside = at.astype(np.int64) + size - (window & 0xFFFF) <= len(text)
        at, window = at[inside], window[inside]
        if not len(at):
            continue
        keys = mix(_gram_hashes(np.frombuffer(text, np.uint8), GRAM)[at])
        for a, w, key, heated in zip(at.tolist(), window.tolist(), keys.tolist(), np.isin(keys, hot).tolist()):
            low, high = w & 0xFFFF, w >> 16
            whole = ((key.to_bytes(8, "big"), low, high),)
            for head, first, last in _blocks(text, a, low, high, size) if heated else whole:
                entry = (head + text[a : a + size - first], text[a - last : a][::-1], first | last << 16)
                entries.setdefault(entry, []).append((own, a))
    return entries


def _run_rows(
    batches: Iterator[pa.RecordBatch], size: int, bits: int, hot: np.ndarray, doc_bits: int
) -> Iterator[pa.RecordBatch]:
    """Sorted runs of the entries of a slice (kind 0), and what entries with
    several owners cover, by document (kind 1, in the first columns)."""
    for part, texts in slices(batches):
        entries = _entries_of(part, texts, size, hot)
        order = sorted(entries)
        again = [
            (own, a - (w >> 16), a - (w & 0xFFFF) + size)
            for (_, _, w), places in entries.items()
            if len(places) > 1
            for own, a in places
        ]
        if again:
            doc, begin, end = (np.array(c, np.int64) for c in zip(*again))
            for batch in _by_document(doc_bits, doc, begin.astype(np.int32), end.astype(np.uint32)):
                none = pa.nulls(batch.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, none, none], names=_RUN_NAMES)
        if not order:
            continue
        buckets = np.array([int.from_bytes(e[0][:8], "big") >> (64 - bits) for e in order], np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
        rows: list[list] = []
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            some = order[a:b]
            prefixes, lengths, rests = front_coded([e[0] for e in some])
            owners = [entries[e] for e in some]
            single = np.array([o[0] for o in owners if len(o) == 1], np.int64)
            rows.append(
                [
                    int(buckets[a]),
                    0,
                    pack(prefixes),
                    pack(lengths),
                    pack(np.frombuffer(rests, np.uint8)),
                    pack(np.frombuffer(b"".join(e[1] for e in some), np.uint8)),
                    pack(np.array([e[2] for e in some], np.uint32)),
                    pack(np.array([len(o) for o in owners], np.int32)),
                    pack(single.ravel()),
                ]
            )
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (len(_RUN_NAMES) - 2)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_RUN_NAMES)


def _merge_range(size: int, doc_bits: int):
    """Merge the runs of a range; kind 1 rows of (document, from, to) covered,
    with those that tasks knew already."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        known = rows.loc[rows["kind"] == 1, _RUN_NAMES[: len(ARROW.names)]].set_axis(ARROW.names, axis=1)
        runs: list[Run] = []
        lefts: list[list[bytes]] = []
        metas, counts, places = [], [], []
        for row in rows[rows["kind"] == 0].itertuples(index=False):
            prefixes, lengths = unpack(row.prefixes, np.uint16), unpack(row.lengths, np.uint16)
            strings = decoded(prefixes, lengths, unpack(row.rests, np.uint8).tobytes())
            runs.append((strings, prefixes.tolist()))
            meta = unpack(row.meta, np.uint32)
            ends = np.cumsum(meta >> 16).tolist()
            left = unpack(row.lefts, np.uint8).tobytes()
            lefts.append([left[a:b] for a, b in zip([0, *ends], ends)])
            metas.append(meta)
            owners = unpack(row.owners, np.int32)
            counts.append(owners)
            place = np.zeros((len(owners), 2), np.int64)
            place[owners == 1] = unpack(row.places, np.int64).reshape(-1, 2)
            places.append(place)
        order = list(merged(runs))
        n = len(order)
        right = np.array([max(0, p - 8) for _, _, p in order], np.int64)
        keys = [runs[r][0][i][:8] for r, i, _ in order]
        left = [lefts[r][i] for r, i, _ in order]
        meta = np.array([metas[r][i] for r, i, _ in order], np.int64)
        count = np.array([counts[r][i] for r, i, _ in order], np.int64)
        low, high = meta & 0xFFFF, meta >> 16
        by_left = sorted(range(n), key=lambda i: (keys[i], left[i]))
        before = np.zeros(n, np.int64)  # shared with the one before in that order
        for j in range(1, n):
            x, y = by_left[j - 1], by_left[j]
            before[j] = shared(left[x], left[y]) if keys[x] == keys[y] else -1
        by_left = np.array(by_left, np.int64)
        covered: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        flags = np.zeros((n, int(high.max()) + 2 if n else 1), bool)
        for offset in range(int(low.min()) if n else 0, int(high.max()) + 1 if n else 0):
            here = np.flatnonzero((low <= offset) & (offset <= high))
            if not len(here):
                continue
            one = np.cumsum(right < size - offset)
            two = np.empty(n, np.int64)
            two[by_left] = np.cumsum(before < offset)
            both = one[here] * (n + 1) + two[here]
            _, back = np.unique(both, return_inverse=True)
            total = np.bincount(back, weights=count[here])
            flags[here[total[back] > 1], offset] = True
        flags[count > 1] = False  # their task has told what they cover
        out: list[tuple[int, int, int]] = []
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        for i, begin in zip(*np.nonzero(edge == 1)):
            covered[i].append((int(begin), int(begin + np.flatnonzero(edge[i, begin:] == -1)[0])))
        for (r, place, _), spans in zip(order, covered):
            doc, at = places[r][place].tolist()
            for first, end in spans:  # offsets first .. end - 1 are repeated
                out.append((doc, at - end + 1, at - first + size))
        doc, a, b = (np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        found = _by_document(doc_bits, doc, a.astype(np.int32), b.astype(np.uint32))
        return pd.concat([known, *(x.to_pandas() for x in found)])

    return run


OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_text binary, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        rows: list[tuple] = []
        for i, (begins, ends) in enumerate(zip(part.column("begin").to_pylist(), part.column("end").to_pylist())):
            text = texts.text(i)
            spans: list[list[int]] = []
            if begins is not None:
                for a, b in zip(unpack(begins, np.int32).tolist(), unpack(ends, np.uint32).tolist()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
            spans = [[a, min(b, len(text))] for a, b in spans if a < len(text)]
            edges = [0, *(x for span in spans for x in span), len(text)]
            left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if spans else text
            rows.append(
                (
                    len(text),
                    len(text) - len(left),
                    len(spans),
                    left if keep_text else None,
                    hashlib.sha256(left).hexdigest(),
                )
            )
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)


def remove_repeated_bytes(
    documents: DataFrame, size: int = SIZE, keep_text: bool = False, hot: int = HOT
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_text, kept_sha256) of every
    document: each byte goes that a `size`-byte string covers which also
    starts anywhere else. kept_text (bytes) is null unless asked for.

    A null text is empty. Texts shorter than `size` keep all. Rows that repeat
    are repeats of each other; rows that share an id, or have none, are judged
    each by its own text. If there are such rows, all rows are numbered first,
    and places go by these numbers."""
    named = documents.select(F.col("doc_id").cast("bigint"), "text")
    again = named.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if again.isEmpty():
        keyed = named.withColumn("id", F.col("doc_id"))
    else:
        keyed = stored(named.withColumn("id", F.monotonically_increasing_id()), "numbered")
    anchors = text_bytes(named) * 2 // (size - GRAM + 1)
    bits, doc_bits = bucket_bits(anchors), bucket_bits(anchors)
    found = _anchor_rows(keyed.select("id", "text"), size, bits, doc_bits)
    settle = _settle(doc_bits, max(hot, anchors // HOT_GRAMS))
    repeated = stored(found.groupBy("bucket").applyInPandas(settle, SCHEMA), "repeated-anchors")
    many, heated = np.zeros(0, np.uint64), 0
    for row in repeated.filter("kind = 2").select("c0", "c1").collect():
        many = np.append(many, unpack(row["c0"], np.uint64, ordered=True))
        heated += int(unpack(row["c1"], np.int64).sum())
    texts = keyed.join(_documents_of(repeated, ["at", "window"], PLACE), "id")
    # An anchor of a hot gram has half of all blocks, more or less.
    entries = anchors // 3 + heated * -(-(size - GRAM + 1) // (2 * BLOCK))
    range_bits = bucket_bits(entries, RANGE_ENTRIES)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _run_rows(batches, size, range_bits, many, doc_bits)

    spans = texts.mapInArrow(runs, RUNS).groupBy("bucket").applyInPandas(_merge_range(size, doc_bits), SCHEMA)
    covered = _documents_of(spans, ["begin", "end"], PLACE)
    joined = keyed.join(stored(covered, "covered"), "id", "left")
    return joined.mapInArrow(lambda batches: _cut(batches, keep_text), OUT)
