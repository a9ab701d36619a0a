"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Training uses a bounded sample of the labelled rows (``max_labelled``, by hash order of the id):
their texts are hashed where they are read, and one task runs the optimiser over the sample.
Per-coordinate rates adapt to how often a feature occurs, and L1 leaves all but a few thousand
weights at zero.  The weights that remain (at most 2**FEATURE_BITS by construction, 12 MB) are
broadcast, and every text is scored in one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.common import Scratch, give_back, plain_text, ship, slices, small_batches

FEATURE_BITS = 20
MAX_LABELLED = 12_000
# Words, neighbours, and skip-grams over one word.
GAPS = ((), (1,), (2,))
BIAS = -1


@dataclass(frozen=True)
class Settings:
    """FTRL: learning rate ``alpha / (beta + sqrt(n))`` per coordinate, and both penalties."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.01
    epochs: int = 4


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature index, and the bias."""

    indices: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << FEATURE_BITS, "f4")
        table[self.indices] = self.weights
        return table


def _features(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By chunk: its first text, and feature indices with the text (from there) they occur in."""
    table = hashing.byte_table(hashing.SYMBOLS)
    data = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    shift = np.uint64(64 - FEATURE_BITS)
    for start, end in hashing.chunks(data):
        hashes, counts = hashing.word_hashes(data[start:end], table)
        found = [hashing.grams(hashes, counts, gaps) for gaps in GAPS]
        index = np.concatenate([(v >> shift).astype("i8") for v, _ in found])
        yield start, index, np.concatenate([t for _, t in found])


def _distinct(index: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A feature counts once per text."""
    both = np.unique((text << FEATURE_BITS) | index)
    return both & ((1 << FEATURE_BITS) - 1), both >> FEATURE_BITS


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, labels = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
        rows = [np.zeros(0, "i4")] * len(texts)
        for start, index, text in _features(texts):
            index, text = _distinct(index, text)
            n = int(text.max()) + 1 if len(text) else 0
            for k, part in enumerate(np.split(index.astype("i4"), np.searchsorted(text, range(1, n)))):
                rows[start + k] = part
        yield pa.RecordBatch.from_pydict(
            {"order": batch.column("order"), "toxic": pa.array(labels, pa.int32()),
             "features": pa.array(rows, pa.list_(pa.int32()))}
        )


def _fit(settings: Settings):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            rows += list(batch.column("features").to_numpy(False))
            labels += batch.column("toxic").to_pylist()
        size = (1 << FEATURE_BITS) + 1  # the last place is the bias
        z, n = np.zeros(size), np.zeros(size)
        l1 = np.full(size, settings.l1)
        l1[-1] = 0
        positive = sum(labels)
        # Without labels, and before the first update, a text counts as clean.
        prior = np.log((positive + 1) / (len(labels) - positive + 10))

        def weights(at):
            shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
            return -shrunk / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

        for _ in range(settings.epochs):
            for features, label in zip(rows, labels):
                at = np.append(features, size - 1).astype("i8")
                w = weights(at)
                guess = 1 / (1 + np.exp(-np.clip(w.sum() + prior, -30, 30)))
                gradient = guess - label
                root = np.sqrt(n[at] + gradient * gradient)
                z[at] += gradient - (root - np.sqrt(n[at])) / settings.alpha * w
                n[at] += gradient * gradient
        w = weights(np.arange(size))
        kept = np.flatnonzero(w[:-1])
        yield pa.RecordBatch.from_pydict(
            {"feature": np.append(kept, BIAS), "weight": np.append(w[kept], w[-1] + prior)}
        )

    return fit


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    settings: Settings = Settings(),
) -> Model:
    """Fit on at most ``max_labelled`` rows of ``labels`` (``doc_id, toxic``), by hash of the id.

    Rows without id or label are left out; a document labelled twice is toxic if any label says
    so.  Rows that share an id are one example, with the least of their feature lists, so the sample
    keeps its bound whatever repeats.  With no usable label the model has only a
    bias, by which every text is clean.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    order = F.xxhash64("doc_id").alias("order")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .select("doc_id", "toxic", order)
        .orderBy("order")
        .limit(max_labelled)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most max_labelled rows of twenty bytes are broadcast.
    sample = texts.join(F.broadcast(chosen), "doc_id").select("order", "text", "toxic")
    rows = sample.mapInArrow(_feature_rows, "order long, toxic int, features array<int>")
    rows = rows.groupBy("order", "toxic").agg(F.min("features").alias("features"))
    rows = scratch.stage(rows, "sample")
    one = rows.coalesce(1).sortWithinPartitions("order", "features").select("toxic", "features")
    found = one.mapInArrow(_fit(settings), "feature long, weight double").toArrow()
    scratch.drop(rows)
    feature, weight = found["feature"].to_numpy(), found["weight"].to_numpy()
    bias = weight[feature == BIAS]
    kept = feature != BIAS
    return Model(feature[kept], weight[kept], float(bias[0]) if len(bias) else -np.log(10.0))


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Probability that a text is toxic; null and empty texts get that of the bias alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.indices, model.weights, model.bias))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = Model(*shared.value).dense()
        bias = shared.value[2]
        for texts in batches:
            sums = np.full(len(texts), bias)
            for first in range(0, len(texts), 512):  # so that its features stay small beside the texts
                for start, index, of in _features(list(texts.iloc[first : first + 512])):
                    hit = table[index] != 0
                    index, of = _distinct(index[hit], of[hit])
                    np.add.at(sums, of + start + first, table[index].astype("f8"))
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -700, 700))))
        give_back()

    return probability(plain_text(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of all ids that no label is learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Learns from labels outside the held-out fifth.  A null ``doc_id`` belongs to no fold and is
    not held out.  Repeated rows get the same score; other columns are not read.
    """
    model = train(docs, labels.where(~held_out()), **options)
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        score(model, docs).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = train(docs, labels.where(~held_out()), **options)
    return docs.where(score(model, docs) < 0.5)


ship(__name__)
