"""Toxicity: logistic regression learnt by FTRL-proximal.

A text is the set of its hashed unigrams, bigrams and skip-grams (pairs with
one word between). The learner goes through a bounded sample of labelled texts
with a learning rate per coordinate and L1 shrinkage, which leaves a few
hundred weights other than zero. The model has at most 2 ** BITS coordinates
whatever the data, so it is sent to all tasks; every text is scored by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.texts import Texts, mix, slices

BITS = 20
# The bound of the training sample: rows with the smallest hash of their id.
TRAIN_ROWS = 12_000
# The order of a pass over them.
SEED = 11


@dataclass(frozen=True)
class Rates:
    """How the learner goes: passes over the sample, the rate of a coordinate,
    alpha / (beta + root of its squared gradients), and its shrinkage. Toxic
    texts are the rarer ones, so their gradients count `toxic_weight` times."""

    epochs: int = 5
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.5
    toxic_weight: float = 3.0


@dataclass(frozen=True)
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << BITS, np.float32)
        weights[self.index] = self.weight
        return weights


def features(texts: Texts) -> list[np.ndarray]:
    """Distinct feature numbers of each text."""
    words = texts.words(lower=True)
    h, documents = words.hashes, words.documents()
    found, owners = [h], [documents]
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        same = documents[gap:] == documents[:-gap] if len(h) > gap else np.zeros(0, bool)
        pair = mix(h[:-gap] * np.uint64(3) + h[gap:] + np.uint64(salt)) if len(h) > gap else h[:0]
        found.append(pair[same])
        owners.append(documents[:-gap][same] if len(h) > gap else documents[:0])
    code = np.concatenate(found) >> np.uint64(64 - BITS)
    owner = np.concatenate(owners).astype(np.uint64)
    both = np.unique((owner << np.uint64(32)) | code)
    cuts = np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    numbers = (both & np.uint64(0xFFFFFFFF)).astype(np.int32)
    return [numbers[a:b] for a, b in zip(cuts, cuts[1:])]


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Learner:
    """FTRL-proximal state; the last coordinate is the bias, never shrunk by L1."""

    def __init__(self, rates: Rates):
        self.rates = rates
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        rates = self.rates
        z, l1 = self.z[at], np.where(at == 1 << BITS, 0.0, rates.l1)
        rate = (rates.beta + np.sqrt(self.n[at])) / rates.alpha + rates.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def learn(self, numbers: np.ndarray, label: int) -> None:
        at = np.append(numbers, 1 << BITS)
        w = self.weights(at)
        g = (sigmoid(w.sum()) - label) * (self.rates.toxic_weight if label else 1.0)
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.rates.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def _fit(batches: Iterator[pa.RecordBatch], rates: Rates) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[np.ndarray, int]] = []
    for part, texts in slices(batches):
        rows += zip(features(texts), part.column("toxic").to_pylist())
    if not rows:
        return
    learner, order = Learner(rates), np.random.default_rng(SEED)
    for _ in range(rates.epochs):
        for i in order.permutation(len(rows)):
            learner.learn(*rows[i])
    weights = learner.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(weights)
    at = np.union1d(at, [1 << BITS])
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], names=["feature", "weight"])


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic): labelled texts outside the held-out fold, one of
    each id (that of smallest hash, where an id repeats).

    If more than `rows` labels of ids that `documents` has qualify, those with
    the smallest hash of their id are taken. That bound holds for the texts as
    well, and makes the label side small enough to broadcast.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(documents.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    least = texts.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    return least.select("doc_id", "least.text", "toxic")


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, rates: Rates = Rates()) -> Model:
    """Fit on at most `rows` labelled texts. Without any, every score is the
    prior: nothing is known, and the model says 'not toxic'."""
    chosen = training_rows(documents, labels, rows)
    # The sample is bounded and the learner goes through it in order: one task.
    ordered = chosen.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text")
    fitted = ordered.mapInArrow(lambda batches: _fit(batches, rates), "feature bigint, weight double")
    table = fitted.toPandas().sort_values("feature")
    if table.empty:
        return Model(-5.0, np.zeros(0, np.int64), np.zeros(0, np.float32))
    index, weight = table["feature"].to_numpy(np.int64), table["weight"].to_numpy()
    return Model(float(weight[-1]), index[:-1], weight[:-1].astype(np.float32))


def score(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """`keep` columns and `score`, the probability of toxic, of every text.
    Null and empty texts get the score of no evidence, the bias."""
    fields = [documents.schema[name] for name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        dense = model.dense()
        for part, texts in slices(batches):
            scores = [float(sigmoid(model.bias + dense[at].sum(dtype=np.float64))) for at in features(texts)]
            columns = [part.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*keep, "score"])

    columns = list(dict.fromkeys([*keep, "text"]))
    return documents.select(*columns).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def toxicity(
    documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, rates: Rates = Rates()
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, scored by the
    model fitted to `labels` outside the held-out fold. Rows that repeat are
    scored each; a null doc_id is in no fold; labels that are neither 0 nor 1,
    or of unknown documents, teach nothing."""
    model = train(documents, labels, rows, rates)
    scored = score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
