"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Words are hashed into ``BUCKETS`` rows, each with a sparse random index vector made from its
number. A word's context vector is the sum of the index vectors of its neighbours in all
documents, summed over the corpus in Spark. A document is the mean and the spread of its words'
vectors, how alike neighbouring vectors are and how often they are the same. A two-layer network on these is trained on a bounded sample of labelled documents; its
temperature is fitted on rows it was not trained on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import fold, texts
from filetally.llm.sample import LIMIT, labelled_texts
from filetally.llm.text import PIECE, batch_of, buffer_of, column, mix, runs, words

BUCKETS = 8192
SIZE = 32  # of a vector
MARKS = 4  # entries of an index vector that are not 0
REACH = 2  # neighbours on either side
POOLED = 2 * SIZE + 3

HIDDEN = 24
EPOCHS = 40
BATCH = 256


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    numbers = np.arange(BUCKETS * MARKS, dtype=np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        random = mix(numbers * np.uint64(0x9E3779B97F4A7C15))
    places = (random % np.uint64(SIZE)).astype(np.int64).reshape(BUCKETS, MARKS)
    signs = np.where(random >> np.uint64(63), 1.0, -1.0).reshape(BUCKETS, MARKS)
    return places, signs


def bucket_words(data, bounds):
    """Bucket of every word of a piece and the words before each text."""
    hashes, _, _, before = words(data, bounds)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), before


CONTEXTS = pa.schema([("bucket", pa.int32()), *[(f"v{k}", pa.int64()) for k in range(SIZE)]])


def context_sums(batches):
    """Sums of neighbours' index vectors by bucket, of one partition."""
    places, signs = index_vectors()
    total = np.zeros(BUCKETS * SIZE)
    for batch in batches:
        data, bounds = buffer_of(column(batch, "text"))
        for first, end in runs(bounds, PIECE):
            low = bounds[first]
            bucket, before = bucket_words(data[low : bounds[end]], bounds[first : end + 1] - low)
            owner = np.repeat(np.arange(end - first), np.diff(before))
            for step in range(1, REACH + 1):
                same = owner[step:] == owner[:-step]
                left, right = bucket[:-step][same], bucket[step:][same]
                for word, near in ((left, right), (right, left)):
                    for m in range(MARKS):
                        cell = word * SIZE + places[near, m]
                        total += np.bincount(cell, signs[near, m], BUCKETS * SIZE)
    rows = total.reshape(BUCKETS, SIZE).astype(np.int64)
    seen = np.flatnonzero(rows.any(axis=1))
    yield batch_of(CONTEXTS, bucket=seen, **{f"v{k}": rows[seen, k] for k in range(SIZE)})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors by bucket, without what all words have in common."""
    fields = [f"v{k}" for k in range(SIZE)]
    sums = (
        docs.mapInArrow(context_sums, "bucket int, " + ", ".join(f"{f} long" for f in fields))
        .groupBy("bucket")
        .agg(*[F.sum(f).alias(f) for f in fields])
        .collect()
    )
    vectors = np.zeros((BUCKETS, SIZE))
    for r in sums:
        vectors[r.bucket] = r[1:]

    def unit(rows):
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    vectors = unit(vectors)
    seen = vectors.any(axis=1)
    if seen.any():
        vectors[seen] = unit(vectors[seen] - vectors[seen].mean(axis=0))
    return vectors.astype(np.float32)


def pooled(batch: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors of each text, their likeness, and its length."""
    data, bounds = buffer_of(column(batch, "text"))
    parts = [np.zeros((0, POOLED))]
    for first, end in runs(bounds, PIECE // 4):
        low = bounds[first]
        bucket, before = bucket_words(data[low : bounds[end]], bounds[first : end + 1] - low)
        count = np.diff(before)
        rows = np.zeros((end - first, POOLED))
        some = count > 0
        if some.any():
            of_word = vectors[bucket]
            starts = before[:-1][some]
            mean = np.add.reduceat(of_word, starts, axis=0) / count[some, None]
            square = np.add.reduceat(of_word * of_word, starts, axis=0) / count[some, None]
            rows[some, :SIZE] = mean
            rows[some, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
            owner = np.repeat(np.arange(end - first), count)
            inner = owner[1:] == owner[:-1]
            alike = (of_word[1:] * of_word[:-1]).sum(axis=1) * inner
            again = (bucket[1:] == bucket[:-1]) & inner
            rows[:, -3] = np.bincount(owner[1:], alike, end - first) / np.maximum(count - 1, 1)
            rows[:, -2] = np.bincount(owner[1:], again, end - first) / np.maximum(count - 1, 1)
        rows[:, -1] = np.log1p(count)
        parts.append(rows)
    return np.concatenate(parts)


@dataclass
class Network:
    """Two layers over standardised inputs; the temperature divides the last one."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        hidden = np.tanh((x - self.centre) / self.scale @ a + b)
        return hidden @ c + d

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Network | None:
    """Adam on four rows of five, temperature on the fifth; None without both labels."""
    if len(np.unique(y)) < 2:
        return None
    random = np.random.default_rng(0)
    held = np.arange(len(y)) % 5 == 4
    train_x, train_y = x[~held], y[~held]
    net = Network(
        train_x.mean(axis=0),
        train_x.std(axis=0) + 1e-6,
        [
            random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ],
    )
    first = [np.zeros_like(w) for w in net.weights]
    second = [np.zeros_like(w) for w in net.weights]
    z = (train_x - net.centre) / net.scale
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(z)), max(1, len(z) // BATCH)):
            a, b, c, d = net.weights
            inputs = z[rows]
            hidden = np.tanh(inputs @ a + b)
            error = 1 / (1 + np.exp(-(hidden @ c + d))) - train_y[rows]
            back = np.outer(error, c) * (1 - hidden**2)
            n = len(rows)
            gradients = [
                inputs.T @ back / n + 1e-4 * a,
                back.mean(axis=0),
                hidden.T @ error / n + 1e-4 * c,
                np.array([error.mean()]),
            ]
            step += 1
            for k, g in enumerate(gradients):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                net.weights[k] = net.weights[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    if len(np.unique(y[held])) == 2:
        margin, target = net.margin(x[held]), y[held]
        choices = np.exp(np.linspace(-1.5, 2.5, 81))
        losses = [np.logaddexp(0, -np.where(target == 1, 1, -1) * margin / t).mean() for t in choices]
        net.temperature = float(choices[int(np.argmin(losses))])
    return net


ROWS = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])


def learn(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, limit: int) -> Network | None:
    """Network of at most ``limit`` labelled texts outside fold 0; their vectors are collected."""

    def measured(batches):
        for batch in batches:
            yield batch_of(
                ROWS,
                doc_id=column(batch, "doc_id"),
                label=column(batch, "label"),
                x=pooled(batch, vectors).tolist(),
            )

    rows = (
        labelled_texts(docs, labels, "quality", limit)
        .mapInArrow(measured, "doc_id long, label int, x array<double>")
        .groupBy("doc_id")  # an id with several texts counts once
        .agg(F.max(F.struct("label", "x")).alias("row"))
        .select("doc_id", "row.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    if not rows:
        return None
    return fit(np.array([r.x for r in rows]), np.array([r.label for r in rows]))


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


def score_quality(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Quality of every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, quality).

    ``held_out`` marks fold 0, of which no label is learned; word vectors come from all texts.
    Each row gives one row, repeated ones included. Null and empty texts have zero vectors and
    the score the network gives these. Without labels of both kinds every score is 0. Only
    ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    plain = texts(docs)
    vectors = word_vectors(plain)
    network = learn(plain, labels, vectors, limit)

    def score(batches):
        for batch in batches:
            x = pooled(batch, vectors)
            yield batch_of(
                SCORES,
                doc_id=column(batch, "doc_id"),
                held_out=column(batch, "held_out"),
                score=np.zeros(len(x)) if network is None else network.probability(x),
            )

    marked = texts(docs.withColumn("held_out", fold(5) == 0), "held_out")
    return marked.mapInArrow(score, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )
