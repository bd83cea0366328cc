"""Near-duplicate documents by SuperMinHash, banding and verified links.

1. Each text becomes its set of word shingles and a SuperMinHash signature:
   every shingle walks a random permutation of the slots, rank by rank, and a
   slot keeps its least (rank + fraction); a text stops at the rank that no
   slot waits for, usually the second or third. Texts with the same set form a
   class and go on as one.
2. Signatures are cut into bands; classes that agree in a band share a bucket.
3. In each bucket the class that shares most buckets with others leads: the
   others are compared with it, on their full sets, and links join components
   by union-find. A bucket of near copies of one text mostly ends here.
4. Buckets that still hold several components chain them into clusters. The
   classes of a cluster meet in blocks of bounded size, every block with every
   other except two of one component; inverted lists of shingles count what
   sets share. No pair of classes is ever a row, and no link between classes
   that share a bucket is left out.

A set is sent on as the keys of its bands. How many there are goes by the
similarity asked for: 25 bands of 5 slots at 0.85 and 37 at 0.8, so that two
sets of just that similarity share no bucket with a probability of 4e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.components import components
from basketflow.llm.ranks import ids_are_keys, numbered
from basketflow.llm.texts import MISSING_ID, Texts, as_texts, mix, slices
from basketflow.session import stored

SHINGLE = 5
BANDS, BAND_SLOTS = 25, 5
SLOTS = BANDS * BAND_SLOTS
PERCENT = 85
# Two sets of just the similarity asked for may miss each other so often.
MISSED = 4.3e-7
# Text of a block; a task compares two of them at a time.
BLOCK_BYTES = 2 << 20


def shingle_sets(texts: Texts, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle
    are one together, and no words are the empty set."""
    words = texts.words(lower=True)
    at, keys = words.windows(size)
    cuts = np.searchsorted(at, words.bounds)
    rolling = words.rolling()
    sets = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            sets.append(np.unique(keys[a:b]))
        else:
            sets.append(rolling.hash(words.bounds[i : i + 1], words.bounds[i + 1 : i + 2]))
            if words.bounds[i] == words.bounds[i + 1]:
                sets[-1] = sets[-1][:0]
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    one = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return np.array([one, two ^ np.uint64(len(shingles))], ">u8").tobytes()


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row of `slots` numbers for each set.

    Rank j of an element has a fraction of 24 bits and the slot that a
    Fisher-Yates shuffle, driven by the element, puts at place j. All sets go
    through a rank together; those whose slots are all below it are done."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    table = np.full((len(sets), slots), 0xFFFFFFFF, np.uint32)
    order = None
    for j in range(slots):
        draw = mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        at = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot, first = at, at
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
                rows = np.arange(len(element))
                order[rows, first] = 0
                order[rows, 0] = first
            slot = order[rows, at].astype(np.int64)
            order[rows, at] = order[:, j]
        value = (np.uint32(j) << np.uint32(24)) | (draw >> np.uint64(40)).astype(np.uint32)
        np.minimum.at(table.reshape(-1), owner * slots + slot, value)
        waiting = table.max(axis=1) >= np.uint32(j + 1) << np.uint32(24)
        stay = waiting[owner]
        if not stay.any():
            break
        if not stay.all():
            owner, element, first = owner[stay], element[stay], first[stay]
            if order is not None:
                order, rows = order[stay], np.arange(len(element))
    return table


def bands_for(percent: int) -> int:
    """The bands that sets of this similarity need to miss each other no more
    often than MISSED."""
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** BAND_SLOTS)))


def band_keys(table: np.ndarray, bands: int) -> np.ndarray:
    """The key of each band of each signature."""
    table = table.astype(np.uint64).reshape(-1, bands, BAND_SLOTS)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), table.shape[:2]).copy()
    for i in range(BAND_SLOTS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, :, i])
    return key


def _class_rows(batches: Iterator[pa.RecordBatch], bands: int) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches, limit=1 << 20):
        sets = shingle_sets(texts)
        keys = band_keys(signatures(sets, bands * BAND_SLOTS), bands)
        full = [len(s) > 0 for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) if f else None for s, f in zip(sets, full)], pa.binary()),
                pa.array([row.tobytes() if f else None for row, f in zip(keys, full)], pa.binary()),
                part.column("h"),
            ],
            names=["doc_id", "n_shingles", "c", "keys", "h"],
        )


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64)
        again = np.repeat(np.arange(batch.num_rows), len(keys) // batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("c").take(pa.array(again))], names=["key", "c"])


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for part, left in slices(batches, "text_a", 1 << 20):
        right = as_texts(part.column("text_b"))
        linked = []
        for x, y in zip(shingle_sets(left), shingle_sets(right)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(
            [part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
        )


def _texts_of(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(c, text): one text of each class, found by the class's smallest id and
    the hash of a text it has there. So rows that share an id, or have none,
    meet only the class they are of, and a class met by several keeps one."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            keys = [set_key(s) for s in shingle_sets(texts)]
            right = [k == c for k, c in zip(keys, part.column("c").to_pylist())]
            yield part.select(["c", "text"]).filter(pa.array(right, pa.bool_()))

    keyed = documents.select(F.coalesce("doc_id", F.lit(MISSING_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")
    found = keyed.join(classes, ["id", "h"]).select("c", "text").mapInArrow(check, "c binary, text string")
    return found.groupBy("c").agg(F.min("text").alias("text"))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked if their shingle sets share at least `percent` % of
    their union; component_id is the smallest id that links lead to. Null and empty
    texts, and texts without words, have an empty set, are linked with nothing
    and are their own component. Rows that repeat fall into one component. A
    null id is never the smallest; a component of null ids has a null id."""
    named = documents.select(F.col("doc_id").cast("bigint"), "text")
    bands = bands_for(percent)
    rows = stored(
        named.withColumn("h", F.xxhash64("text")).mapInArrow(
            lambda batches: _class_rows(batches, bands),
            "doc_id bigint, n_shingles bigint, c binary, keys binary, h bigint",
        ),
        "classes",
    )
    classes = rows.filter("c IS NOT NULL").groupBy("c").agg(F.min("keys").alias("keys"))
    bands = stored(classes.select("c", "keys").mapInArrow(_band_rows, "key bigint, c binary"), "bands")
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(bands.join(shared, "key"), "members")
    at = F.struct(F.coalesce("doc_id", F.lit(MISSING_ID)).alias("id"), "h")
    ids = rows.groupBy("c").agg(F.min(at).alias("at")).select("c", "at.id", "at.h")
    wanted = members.groupBy("c").agg(F.sum("n").alias("weight"))
    wanted = stored(wanted, "candidates")
    texts = stored(_texts_of(named, ids.join(wanted.select("c"), "c")), "candidate-texts")
    labels = wanted.select("c", F.col("c").alias("label"))
    labels = _merge(labels, _leader_links(members, wanted, texts, percent))
    labels = _merge(labels, _block_links(members, labels, texts, percent))

    labelled = rows.join(labels, "c", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("label", "c").alias("label"),
    )
    least = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = labelled.join(least, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def keep_first(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, less those of a group but one: the one of
    smallest id. If ids are missing or repeat, rows are judged by numbers that
    ascend with the id: the smallest id still stays, one without id only where
    no other has one, and of equal ids the text of smallest hash."""
    if ids_are_keys(documents):
        gone = near_duplicates(documents, percent).filter(~F.col("kept")).select("doc_id")
        return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    rows = numbered(stored(documents, "documents"), "row_number")
    named = rows.select(F.col("row_number").alias("doc_id"), "text")
    gone = near_duplicates(named, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("row_number"))
    return rows.join(gone, "row_number", "left_anti").select(*documents.columns)


def _leader_links(members: DataFrame, weights: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of classes with the leader of a bucket they are in."""
    weighted = members.select("key", "c").join(weights, "c")
    leaders = weighted.groupBy("key").agg(F.max(F.struct("weight", "c")).alias("best"))
    led = (
        weighted.select("key", "c")
        .join(leaders.select("key", F.col("best.c").alias("leader")), "key")
        .filter("c <> leader")
        .select(F.least("c", "leader").alias("a"), F.greatest("c", "leader").alias("b"))
        .distinct()
    )
    compared = (
        led.join(texts.select(F.col("c").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("c").alias("b"), F.col("text").alias("text_b")), "b")
        .mapInArrow(lambda batches: _compare(batches, percent), "a binary, b binary, linked boolean")
    )
    return compared.filter("linked").select("a", "b")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (c, label) after links between labels."""
    roots = components(links).withColumnRenamed("node", "label")
    joined = labels.join(roots, "label", "left")
    return stored(joined.select("c", F.coalesce("root", "label").alias("label")), "labels")


def linked_labels(
    sets: list[np.ndarray], labels: list[bytes], percent: int = PERCENT
) -> list[tuple[bytes, bytes]]:
    """Links between the labels of some sets, no more than join them up."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    times = np.bincount(token)
    owner, token = owner[times[token] > 1], token[times[token] > 1]
    order = np.argsort(token, kind="stable")
    lists = owner[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(times)))])
    size = np.array([len(s) for s in sets])
    cuts = np.searchsorted(owner, np.arange(len(sets) + 1))
    root = {label: label for label in labels}

    def find(x: bytes) -> bytes:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in range(len(sets)):
        own = token[cuts[i] : cuts[i + 1]]
        if not len(own):
            continue
        both = np.bincount(np.concatenate([lists[begin[t] : begin[t + 1]] for t in own]), minlength=len(sets))
        for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)):
            a, b = find(labels[i]), find(labels[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((labels[i], labels[j]))
    return out


def _block_links(members: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels that share buckets, from comparing all
    classes of a cluster block by block."""
    placed = members.select("key", "c").join(labels, "c")
    hubs = placed.groupBy("key").agg(F.min("label").alias("hub"), F.max("label").alias("other")).filter("hub <> other")
    mixed = stored(placed.join(hubs.select("key", "hub"), "key").select("c", "label", "hub").distinct(), "mixed")
    clusters = components(mixed.select(F.col("label").alias("a"), F.col("hub").alias("b")).distinct())
    named = clusters.select(F.col("node").alias("label"), F.col("root").alias("cluster"))
    unsettled = mixed.select("c", "label").distinct().join(named, "label")
    rows = stored(unsettled.join(texts, "c").withColumn("bytes", F.octet_length("text").cast("bigint")), "unsettled")

    def parts(total: str) -> F.Column:
        return F.ceil(F.col(total) / BLOCK_BYTES).cast("bigint")

    per_label = rows.groupBy("cluster", "label").agg(F.sum("bytes").alias("of_label"))
    per_cluster = per_label.groupBy("cluster").agg(F.sum("of_label").alias("of_cluster"))
    total = per_cluster.agg(F.sum("of_cluster")).first()[0] or 0
    bins = -(-total // BLOCK_BYTES) or 1
    # A large label has blocks of its own; the others of its cluster share
    # some, and clusters of less than a block share one with other clusters.
    home = F.when(F.col("of_label") >= BLOCK_BYTES, F.hex("label")).otherwise("")
    block = F.when(
        F.col("of_cluster") <= BLOCK_BYTES, F.pmod(F.xxhash64("cluster", F.lit(1)), F.lit(bins))
    ).otherwise(
        F.when(F.col("of_label") >= BLOCK_BYTES, F.pmod(F.xxhash64("c", F.lit(2)), parts("of_label"))).otherwise(
            F.pmod(F.xxhash64("label", F.lit(3)), parts("of_cluster"))
        )
    )
    sizes = per_label.join(per_cluster, "cluster")
    area = F.when(F.col("of_cluster") <= BLOCK_BYTES, F.lit("")).otherwise(F.hex("cluster"))
    dealt = rows.join(sizes, ["cluster", "label"]).select(
        "label", "text", area.alias("area"), F.concat_ws(":", home, block).alias("block"), home.alias("home")
    )
    dealt = stored(dealt, "dealt")
    blocks = dealt.select("area", "block", "home").distinct()
    alone = blocks.filter("area = ''").select("area", "block", F.col("block").alias("meeting"))
    several = blocks.filter("area <> ''")
    other = several.select("area", F.col("block").alias("block_b"), F.col("home").alias("home_b"))
    meet = several.join(other, "area").filter("block <= block_b AND (home = '' OR home <> home_b)")
    rooms = meet.withColumn("meeting", F.concat_ws("|", "area", "block", "block_b"))
    both = rooms.select("area", F.explode(F.array_distinct(F.array("block", "block_b"))).alias("block"), "meeting")
    rooms = dealt.join(alone.unionByName(both), ["area", "block"]).select("meeting", "label", "text")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(as_texts(pa.array(frame["text"], pa.large_string())))
        return pd.DataFrame(linked_labels(sets, [bytes(x) for x in frame["label"]], percent), columns=["a", "b"])

    return rooms.groupBy("meeting").applyInPandas(compare, "a binary, b binary")
