"""Repeated passages of words, by compaction of a de Bruijn graph.

Every run of `size` words is an edge of the graph, from the node of its first
size - 1 words to that of its last. An edge's source is the place where it
first stands: the smallest document, then the smallest position. Edges are
exchanged by hash, where each place of an edge learns its source. Along a
document, edges whose sources are consecutive form a path without branches,
which is kept as one span (start, edges, source document, source start). Spans
are joined to both documents they name and compared there by a digest of their
words; one that does not agree is dropped.

What is exchanged per edge is its hash, document and position, once for each
distinct edge of a slice of input, so an edge that stands in a third of all
documents arrives once per slice.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.packed import (
    SCHEMA,
    Ranges,
    gather,
    grouped,
    pack,
    pieces,
    refined,
    text_bytes,
    unpack,
)
from basketflow.llm.texts import MISSING_ID, Texts, Words, ids, mix, slices
from basketflow.session import stored

WINDOW = 13
# Text of a slice of input; its distinct edges are exchanged together.
EDGE_SLICE = 4 << 20
BYTES_PER_EDGE = 6
SPAN = [("start", np.int32), ("edges", np.int32), ("source", np.int64), ("source_start", np.int32)]
SPANS = "doc_id bigint, spans int, start binary, edges binary, source binary, source_start binary"


EDGE = [np.uint64, np.int64, np.int32]
PLACE = [np.int64, np.int32, np.int64, np.int32]
Deal = Callable[[np.ndarray], np.ndarray]


def _places(deal: Deal, doc, pos, source, source_pos) -> Iterator[pa.RecordBatch]:
    """Repeated places with their sources, dealt by document."""
    bucket = deal(mix(doc.view(np.uint64)))
    order = np.lexsort((pos, doc, bucket))
    columns = [x[order] for x in (doc, pos.astype(np.int32), source, source_pos.astype(np.int32))]
    yield from pieces(bucket[order], columns, kind=1)


def _later(keys, doc, pos) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Edges in the order of hash and place; where the first of each hash is;
    and, for the places in larger documents than the first, (it, first)."""
    order = np.lexsort((pos, doc, keys))
    keys, doc, pos = keys[order], doc[order], pos[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    heads = np.flatnonzero(first)
    head = heads[np.cumsum(first) - 1]
    later = np.flatnonzero(doc > doc[head])
    return (keys, doc, pos), heads, np.stack([later, head[later]])


def _folded(deal: Deal, ranges: Ranges, keys, doc, pos) -> Iterator[pa.RecordBatch]:
    """Each edge once, dealt by hash, and its places in larger documents."""
    (keys, doc, pos), heads, (later, source) = _later(keys, doc, pos)
    yield from _places(ranges.first, doc[later], pos[later], doc[source], pos[source])
    yield from pieces(deal(keys[heads]), [keys[heads], doc[heads], pos[heads]])


def edges(documents: DataFrame, ranges: Ranges, size: int) -> DataFrame:
    """Rows of kind 0: distinct edges of a slice, by hash. Kind 1: places
    that repeat an edge of a smaller document of the same slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, limit=EDGE_SLICE):
            words = texts.words()
            at, keys = words.windows(size)
            if not len(at):
                continue
            rows = words.documents()[at]
            doc, pos = ids(part.column("doc_id"))[rows], (at - words.bounds[rows]).astype(np.int32)
            yield from _folded(ranges.first, ranges, keys, doc, pos)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


def repeated_places(edge_rows: DataFrame, ranges: Ranges) -> DataFrame:
    """Kind 1 rows by document: those found in the slices, and the places of
    edges whose source, over all slices, is in a smaller document.

    Edges that need a second step are written between the steps, as their
    places go past the buckets of edges to those of documents."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        (_, doc, pos), _, (later, source) = _later(*gather(rows, EDGE))
        found = _places(ranges.first, doc[later], pos[later], doc[source], pos[source])
        return pd.concat([rows[rows["kind"] == 1], *(batch.to_pandas() for batch in found)])

    if not ranges.deep:
        return grouped(edge_rows, ranges).applyInPandas(run, SCHEMA)
    edge_rows = stored(edge_rows, "edges")
    finer = refined(edge_rows, ranges, EDGE, lambda *columns: _folded(ranges.fine, ranges, *columns))
    finer = stored(finer, "finer-edges")
    found = grouped(finer.filter("kind = 0"), ranges).applyInPandas(run, SCHEMA)
    places = edge_rows.unionByName(finer).filter("kind = 1").unionByName(found)
    return refined(places, ranges, PLACE, lambda *columns: _places(ranges.fine, *columns), kind=1)


def compacted(place_rows: DataFrame, ranges: Ranges) -> DataFrame:
    """One row per document with repeats: its spans, as packed arrays."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        doc, pos, source, source_pos = gather(rows, PLACE, kind=1)
        # A place may be named by its slice and by its bucket: the smaller source holds.
        order = np.lexsort((source_pos, source, pos, doc))
        doc, pos, source, source_pos = (x[order] for x in (doc, pos, source, source_pos))
        keep = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
        doc, pos, source, source_pos = (x[keep] for x in (doc, pos, source, source_pos))
        joined = (
            (doc[1:] == doc[:-1])
            & (pos[1:] == pos[:-1] + 1)
            & (source[1:] == source[:-1])
            & (source_pos[1:] == source_pos[:-1] + 1)
        )
        heads = np.flatnonzero(np.concatenate([[True], ~joined]))
        lengths = np.diff(np.append(heads, len(doc))).astype(np.int32)
        columns = [pos[heads], lengths, source[heads], source_pos[heads]]
        cuts = np.flatnonzero(np.concatenate([[True], doc[heads][1:] != doc[heads][:-1]]))
        ends = np.append(cuts[1:], len(heads))
        frame = {"doc_id": doc[heads][cuts], "spans": ends - cuts}
        for (name, _), values in zip(SPAN, columns):
            frame[name] = [pack(values[a:b]) for a, b in zip(cuts, ends)]
        return pd.DataFrame(frame)

    return grouped(place_rows, ranges).applyInPandas(run, SPANS)


def _digest(words: list[bytes]) -> dict[str, int]:
    """128 bits of a stretch of words, as two numbers, which Spark aggregates
    in hash tables."""
    d0, d1 = struct.unpack("<qq", hashlib.blake2b(b" ".join(words), digest_size=16).digest())
    return {"d0": d0, "d1": d1}


def _requests(targets: DataFrame, size: int) -> DataFrame:
    """(id, asked): the stretches of each source that spans refer to, each
    once. There are no more of them than pairs of places in the source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for row in batch.select(["edges", "source", "source_start"]).to_pylist():
                n, source, start = (unpack(row[k], t) for k, t in SPAN[1:])
                rows.update(zip(source.tolist(), start.tolist(), n.tolist()))
            names = ["id", "start", "edges"]
            columns = zip(*sorted(rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    asked = targets.mapInArrow(run, "id bigint, start bigint, edges bigint").distinct()
    return asked.groupBy("id").agg(F.collect_list(F.struct("start", "edges")).alias("asked"))


JUDGED = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string, "
    "own array<struct<source:bigint,start:bigint,edges:bigint,d0:bigint,d1:bigint>>, "
    "given array<struct<source:bigint,start:bigint,edges:bigint,d0:bigint,d1:bigint>>"
)
_KEYED = pa.list_(
    pa.struct([(name, pa.int64()) for name in ("source", "start", "edges", "d0", "d1")])
)


def _judge(
    batches: Iterator[pa.RecordBatch], size: int, keep_text: bool, carry: list[str]
) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of each text; tell the digests of its own spans and of
    the stretches it is asked for."""
    for part, texts in slices(batches):
        needed = ["id", "refused", "asked", *(name for name, _ in SPAN)]
        columns = {name: part.column(name).to_pylist() for name in needed}
        missing = part.column("text").is_null().to_pylist()
        out: dict[str, list] = {name: [] for name in ("n", "removed", "text", "sha", "own", "given")}
        for i, own_id in enumerate(columns["id"]):
            words = texts.text(i).split()  # bytes.split() cuts at just these six bytes
            own, gone = [], np.zeros(len(words), bool)
            if columns["start"][i] is not None:
                start, n, source, source_start = (unpack(columns[k][i], t) for k, t in SPAN)
                refused = columns["refused"][i] or []
                single = Words(_one(texts, i), False)
                at, keys = single.windows(size)
                hit = np.zeros(len(words) + 1, np.int64)
                for a, m, s, b in zip(start.tolist(), n.tolist(), source.tolist(), source_start.tolist()):
                    inside = a + m + size - 1 <= len(words)
                    stretch = words[a : a + m + size - 1] if inside else []
                    own.append({"source": s, "start": b, "edges": m, **_digest(stretch)})
                    if inside and own[-1] not in refused:
                        hit[a] += 1
                        hit[a + m] -= 1
                # The same words may stand in this document again.
                flagged = np.isin(keys, np.unique(keys[np.cumsum(hit[:-1])[at] > 0]))
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, at[flagged], 1)
                np.add.at(cover, at[flagged] + size, -1)
                gone = np.cumsum(cover[:-1]) > 0
            given = [
                {
                    "source": own_id,
                    "start": q["start"],
                    "edges": q["edges"],
                    **_digest(words[q["start"] : q["start"] + q["edges"] + size - 1]),
                }
                for q in columns["asked"][i] or []
            ]
            left = b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else b" ".join(words)
            out["n"].append(len(words))
            out["removed"].append(int(gone.sum()))
            whole = None if missing[i] else texts.text(i)
            out["text"].append((left if gone.any() else whole) if keep_text else None)
            out["sha"].append(hashlib.sha256(left).hexdigest())
            out["own"].append(own)
            out["given"].append(given)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(out["n"], pa.int64()),
                pa.array(out["removed"], pa.int64()),
                pa.array(out["text"], pa.binary()).cast(pa.string()),
                pa.array(out["sha"]),
                pa.array(out["own"], _KEYED),
                pa.array(out["given"], _KEYED),
                *(part.column(f"carried_{name}") for name in carry),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "own", "given", *carry],
        )


def _one(texts: Texts, i: int) -> Texts:
    data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
    return Texts(data, np.array([0, len(data)]))


KEY = ["source", "start", "edges"]


def _doubtful(judged: DataFrame) -> DataFrame:
    """The stretches on whose words not all agree. Where all do, as is the
    rule, one aggregation of partial minima and maxima shows it."""
    own = judged.select(F.explode("own").alias("s")).select("s.*")
    both = own.unionByName(judged.select(F.explode("given").alias("s")).select("s.*"))
    ends = [f(d).alias(f"{d}_{f.__name__}") for d in ("d0", "d1") for f in (F.min, F.max)]
    return both.groupBy(KEY).agg(*ends).filter("d0_min <> d0_max OR d1_min <> d1_max").select(KEY)


def _refused(judged: DataFrame, doubtful: DataFrame) -> DataFrame:
    """Spans whose words are not those of the stretch they name, by document."""
    own = judged.select("doc_id", F.explode("own").alias("s")).select("doc_id", "s.*")
    given = judged.select(F.explode("given").alias("s")).select("s.*")
    wrong = own.join(doubtful, KEY).join(given.join(doubtful, KEY), [*KEY, "d0", "d1"], "left_anti")
    return wrong.groupBy(F.coalesce("doc_id", F.lit(MISSING_ID)).alias("id")).agg(
        F.collect_set(F.struct(*KEY, "d0", "d1")).alias("refused")
    )


def remove_repeats(
    documents: DataFrame,
    size: int = WINDOW,
    keep_text: bool = False,
    carry: list[str] | None = None,
    ranges: Ranges | None = None,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) of every document,
    and its columns named in `carry`: each word goes that a window of `size`
    words covers which also starts in a document of smaller id. kept_text is
    null unless asked for, and is the text as it was (null, too) if nothing
    went, else the words left, joined by one space. `ranges` follow from the
    bytes of text unless given. A task holds some tens of bytes for each byte
    of the longest text.

    Null and empty texts have no words and keep none. A null id is smaller
    than all others. Rows of one id do not repeat each other; if their texts
    differ, a span holds for the rows whose words agree with it.
    """
    named = documents.select(F.col("doc_id").cast("bigint"), "text")
    ranges = ranges or Ranges(text_bytes(named) // BYTES_PER_EDGE)
    places = repeated_places(edges(named, ranges, size), ranges)
    targets = stored(compacted(places, ranges), "spans").withColumnRenamed("doc_id", "id")
    asked = _requests(targets, size)
    carry = carry or []
    keyed = documents.select(
        F.col("doc_id").cast("bigint"),
        "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(MISSING_ID)).alias("id"),
        *(F.col(name).alias(f"carried_{name}") for name in carry),
    )
    carried = "".join(f", `{n}` {documents.schema[n].dataType.simpleString()}" for n in carry)
    joined = keyed.join(targets, "id", "left").join(asked, "id", "left")

    def judge(rows: DataFrame) -> DataFrame:
        run = lambda batches: _judge(batches, size, keep_text, carry)
        return stored(rows.mapInArrow(run, JUDGED + carried), "judged")

    none = F.array().cast("array<struct<source:bigint,start:bigint,edges:bigint,d0:bigint,d1:bigint>>")
    judged = judge(joined.withColumn("refused", none))
    doubtful = stored(_doubtful(judged), "doubtful")
    if not doubtful.isEmpty():
        refused = stored(_refused(judged, doubtful), "refused")
        judged = judge(joined.join(refused, "id", "left"))
    return judged.drop("own", "given")
