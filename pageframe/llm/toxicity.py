"""Toxicity of texts by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.llm.rows import text_of

BITS = 20
#: Labelled rows that are learned from, at most: those whose doc_id hashes lowest.
SAMPLE = 16_000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 1.0, 1.0, 5.0, 1.0
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_HASHES: dict[bytes, int] = {}


def buckets(text: bytes, bits: int = BITS) -> np.ndarray:
    """Buckets of all words, pairs of neighbours, and pairs with one word between, repeats included."""
    words = _WORD.findall(text.lower())
    if len(_HASHES) > 500_000:
        _HASHES.clear()
    try:
        h = [_HASHES[w] for w in words]
    except KeyError:
        for w in words:
            if w not in _HASHES:
                _HASHES[w] = xxhash.xxh64_intdigest(w)
        h = [_HASHES[w] for w in words]
    h = np.array(h, np.uint64)
    one, pair, skip = h * _ODD[0], h[:-1] * _ODD[1] + h[1:], h[:-2] * _ODD[2] + h[2:] * _ODD[3]
    mixed = np.concatenate([one, pair, skip])
    mixed ^= mixed >> np.uint64(29)
    return (mixed * _ODD[0] >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """Per-coordinate rates and L1 sparsity; a feature is there or not, bucket ``1 << bits`` is the intercept."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """``at``: distinct buckets of a text, the intercept among them."""
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


@dataclass
class Model:
    """The buckets with a weight, and the weights: what every task gets. At most 12 bytes x 2^bits."""

    buckets: np.ndarray
    values: np.ndarray
    bits: int = BITS


def train(docs: DataFrame, known: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, bits: int = BITS) -> Model:
    """A model learned from the texts of ``docs`` (doc_id, text) that ``known`` (doc_id, label 0 or 1) labels.

    Of the labelled ids the ``sample`` that hash lowest are learned from; these alone go to the tasks
    that read the texts, so no text is shuffled. Buckets of the texts are made where the texts are;
    of rows with equal doc_id one counts. The updates follow one another, so one task makes them, in
    the order of another hash; it holds the distinct buckets of at most ``sample`` texts. Without
    rows the model has no weights.
    """
    chosen = known.select("doc_id", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", "label", "doc_id", F.xxhash64(F.col("doc_id"), F.lit("order")).alias("h"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(buckets(t.as_py(), bits)) for t in batch.column("text")]
            columns = [batch.column(c) for c in ("doc_id", "h", "label")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "h", "label", "at"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        labels, rows, model = table.column("label").to_pylist(), table.column("at"), Ftrl(bits)
        for _ in range(epochs):
            for label, at in zip(labels, rows, strict=True):
                model.learn(np.append(at.values.to_numpy(zero_copy_only=False), 1 << bits).astype(np.int64), label)
        w = model.weights()
        at = np.flatnonzero(w)
        return pa.table({"at": pa.array([at.tolist()], pa.list_(pa.int64())), "w": pa.array([w[at].tolist()], pa.list_(pa.float64()))})

    rows = rows.mapInArrow(features, "doc_id long, h long, label int, at array<int>")
    rows = rows.groupBy("doc_id", "h", "label").agg(F.min("at").alias("at")).drop("doc_id")
    found = rows.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(learn, "at array<long>, w array<double>").first()
    if found is None:
        return Model(np.zeros(0, np.int64), np.zeros(0), bits)
    return Model(np.array(found["at"], np.int64), np.array(found["w"]), bits)


def score(docs: DataFrame, model: Model, carry: list[Column]) -> DataFrame:
    """The columns of ``carry`` and ``score``, 0 to 1, of each whole text; a null text counts as empty."""
    bits = model.bits
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.values))  # plain arrays
    narrow = docs.select(*carry, text_of().alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used_buckets, values = shared.value
        weights = np.zeros((1 << bits) + 1)
        weights[used_buckets] = values
        used = weights != 0
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            sums = []
            for text in batch.column(at):
                found = buckets(text.as_py(), bits)
                sums.append(weights[np.unique(found[used[found]])].sum() + weights[-1])
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums, float), -30, 30)))
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [f.name for i, f in enumerate(batch.schema) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=[*names, "score"])

    return narrow.mapInArrow(run, narrow.drop("_text").withColumn("score", F.lit(0.0)).schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def rated(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Learns from the rows of ``labels`` (doc_id, toxic) that are not held out. Empty and null texts get
    the score of the intercept; null labels and labels of unknown documents are not used; repeated
    rows are scored each; without labels every score is 0.5. Other columns are never read.
    """
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    model = train(docs, known, **kw)
    scored = score(docs, model, [F.col("doc_id")])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
