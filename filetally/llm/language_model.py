"""LM scoring: hashed maximum-entropy model with class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``. Frequent words are classes of
their own; the others fall into classes by a hash of their ending. The class softmax has four
weights for every class: a bias, the class of the word before (bigram), a bucket of the class
two words before (skip) and a hashed pair of both (trigram). All features of a token follow
from its two context classes, so the table of (context, class) counts over all training texts
is a sufficient statistic: gradient passes run over that table's partitions and give the
gradient of the whole corpus. The word factor uses the exact counts of all training texts.

Texts are tokenised once into chunks: token codes with the chunk's own vocabulary. Vocabularies
meet the corpus counts in a shuffle join and return to their chunk, so the dictionary is never
held whole anywhere. Chunks hold about ``CHUNK`` bytes of text, or one longer text.

A chunk's vocabulary has some 100,000 words. It is kept as compressed bytes and becomes rows in
the Python workers, a few at a time: as arrays of the JVM it filled the executors' heaps, and
pages and row groups of many chunks the buffers beside them.
"""

from __future__ import annotations

import secrets
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import fold, materialize, texts
from filetally.llm.text import batch_of, buffer_of, column, first_places, runs, slices, words

CHUNK = 4 << 20
ADDED = 0.1  # to every count
END = "< >"  # the end token; it holds a space, so no word equals it

CHUNKS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("trained", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())),
        ("wide", pa.bool_()),
        ("codes", pa.binary()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
    ]
)
CHUNKS_SQL = (
    "chunk long, ids array<long>, trained array<boolean>, sizes array<int>, wide boolean, "
    "codes binary, words binary, counts binary"
)
# A reader holds a row group, and a codec a page; unless told, Parquet looks at sizes only after
# 100 rows, which are 100 chunks.
STORED = {
    "parquet.block.size": 8 << 20,
    "parquet.block.size.row.check.min": 1,
    "parquet.page.size.row.check.min": 1,
}


@dataclass(frozen=True)
class Shape:
    """Sizes of the class model; the weights are bounded by them, not by the corpus."""

    frequent: int = 63  # words that are classes of their own
    endings: int = 64  # classes of all other words
    skips: int = 16  # buckets of the class two words before
    pairs: int = 1024  # buckets of context pairs
    rounds: int = 12
    prior: float = 2.0  # expected counts are smoothed by this much

    @property
    def classes(self) -> int:
        return 1 + self.frequent + self.endings  # class 0 is the end, and the start before it


def tokenise(batches):
    """Chunks of token codes, with the vocabulary of each and its counts in training texts."""
    for batch in batches:
        data, bounds = buffer_of(column(batch, "text"))
        ids = column(batch, "doc_id")
        trained = column(batch, "trained").to_numpy(zero_copy_only=False).astype(bool)
        for first, end in runs(bounds, CHUNK):
            low = bounds[first]
            part = data[low : bounds[end]]
            hashes, starts, ends, before = words(part, bounds[first : end + 1] - low)
            codes, kinds = pd.factorize(hashes)
            places = first_places(codes, len(kinds))
            sizes = np.diff(before)
            in_training = np.repeat(trained[first:end], sizes)
            lower = part.copy()
            lower[(part >= 65) & (part <= 90)] += 32
            wide = len(kinds) > 1 << 16
            yield batch_of(
                CHUNKS,
                chunk=[secrets.randbits(63)],
                ids=pa.array([ids.slice(first, end - first).to_pylist()], CHUNKS.field("ids").type),
                trained=[trained[first:end].tolist()],
                sizes=[sizes.astype(np.int32)],
                wide=[wide],
                codes=[packed(codes, wide)],
                words=[packed_words(slices(lower, starts[places], ends[places]))],
                counts=[packed_counts(np.bincount(codes[in_training], minlength=len(kinds)))],
            )


def packed(codes: np.ndarray, wide: bool) -> bytes:
    """Compressed codes, one plane per byte: frequent words come early, so high bytes repeat."""
    planes = [(codes >> shift).astype(np.uint8) for shift in ((0, 8, 16) if wide else (0, 8))]
    return pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, wide: bool) -> np.ndarray:
    width = 3 if wide else 2
    raw = pa.decompress(data, decompressed_size=count * width, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, count)
    return sum(plane.astype(np.int64) << (8 * k) for k, plane in enumerate(planes))


def packed_words(names: pa.Array) -> bytes:
    """Compressed words of a chunk, joined by the space that none of them holds."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), " ")
    return pa.compress(joined[0].as_buffer(), codec="zstd", asbytes=True)


def packed_counts(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype(np.int64).tobytes(), codec="zstd", asbytes=True)


def expanded(data: pa.BinaryScalar) -> pa.Buffer:
    with pa.CompressedInputStream(pa.BufferReader(data.as_buffer()), "zstd") as stream:
        return stream.read_buffer()


def unpacked_words(data: pa.BinaryScalar) -> pa.Array:
    joined = expanded(data)
    if not joined.size:
        return pa.array([], pa.string())
    bounds = pa.py_buffer(np.array([0, joined.size], np.int32))
    return pc.split_pattern(pa.StringArray.from_buffers(1, bounds, joined), " ").values


PLACES = pa.schema(
    [("chunk", pa.int64()), ("place", pa.int32()), ("word", pa.string()), ("n", pa.int64())]
)
PLACES_SQL = "chunk long, place int, word string, n long"
PLACED = 1 << 15  # words of a vocabulary that leave a worker at once


def vocabularies(batches):
    """The words of each chunk with their place among its codes, and their counts in it."""
    for batch in batches:
        for k in range(batch.num_rows):
            chunk = column(batch, "chunk")[k].as_py()
            names = unpacked_words(column(batch, "words")[k])
            counts = np.frombuffer(expanded(column(batch, "counts")[k]), np.int64)
            for first in range(0, len(names), PLACED):
                some = names.slice(first, PLACED)
                yield batch_of(
                    PLACES,
                    chunk=np.full(len(some), chunk),
                    place=np.arange(first, first + len(some), dtype=np.int32),
                    word=some,
                    n=counts[first : first + PLACED],
                )


def word_classes(names: pa.Array, frequent: list[str], shape: Shape) -> np.ndarray:
    """Class of each word: its rank if it is frequent, else by its last letters and mark."""
    data, bounds = buffer_of(names)
    data = np.concatenate([np.zeros(3, np.uint8), data]).astype(np.int64)
    last, sizes = bounds[1:] + 2, np.diff(bounds)
    tail = [np.where(sizes > k, data[last - k], 0) for k in range(3)]
    mark = (tail[0] < 128) & ~(
        ((tail[0] >= 97) & (tail[0] <= 122)) | ((tail[0] >= 48) & (tail[0] <= 57))
    )
    key = np.where(mark, tail[0] * 65536 + tail[1] * 256 + tail[2], tail[0] * 256 + tail[1])
    by_ending = (key * 2654435761 % (1 << 32) >> 7) % shape.endings
    rank = pc.index_in(names, pa.array(frequent, pa.string()))
    rank = pc.fill_null(rank, -1).to_numpy(zero_copy_only=False)
    out = np.where(rank >= 0, 1 + rank, 1 + shape.frequent + by_ending).astype(np.int64)
    out[pc.equal(names, END).to_numpy(zero_copy_only=False)] = 0
    return out


def streams(row, kinds: np.ndarray, shape: Shape):
    """Class, context class and skip bucket of every token of a chunk, ends included."""
    sizes = np.asarray(row["sizes"], np.int64)
    codes = unpacked(row["codes"], int(sizes.sum()), row["wide"])
    stops = np.cumsum(sizes + 1) - 1
    here = np.zeros(len(codes) + len(sizes), np.int64)
    inner = np.ones(len(here), dtype=bool)
    inner[stops] = False
    here[inner] = kinds[codes]
    back = np.concatenate([[0], here[:-1]])
    skip = np.where(back == 0, 0, np.concatenate([[0, 0], here[:-2]])[: len(here)])
    return here, back, skip % shape.skips, inner, codes, sizes, stops


COUNTS = pa.schema([("context", pa.int64()), ("kind", pa.int64()), ("n", pa.int64())])


def context_counter(frequent: list[str], shape: Shape):
    """Function for ``mapInArrow``: counts of (context, class) of the training texts."""

    def run(batches):
        cells = shape.classes * shape.skips * shape.classes
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: column(batch, n)[k].as_py() for n in ("sizes", "codes", "wide")}
                kinds = word_classes(unpacked_words(column(batch, "words")[k]), frequent, shape)
                here, back, skip, _, _, sizes, _ = streams(row, kinds, shape)
                kept = np.repeat(np.asarray(column(batch, "trained")[k].as_py(), bool), sizes + 1)
                cell = (back * shape.skips + skip) * shape.classes + here
                total += np.bincount(cell[kept], minlength=cells)
        seen = np.flatnonzero(total)
        yield batch_of(COUNTS, context=seen // shape.classes, kind=seen % shape.classes, n=total[seen])

    return run


KINDS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("kind", pa.int16())])


def classifier(frequent: list[str], shape: Shape):
    """Function for ``mapInArrow``: dictionary rows with the class of each word."""

    def run(batches):
        for batch in batches:
            names = column(batch, "word")
            kinds = word_classes(names, frequent, shape)
            yield batch_of(KINDS, word=names, n=column(batch, "n"), kind=kinds.astype(np.int16))

    return run


def features(contexts: np.ndarray, shape: Shape) -> list[np.ndarray]:
    """Rows of the weight table active in a context: bias, bigram, skip, hashed pair."""
    back, skip = contexts // shape.skips, contexts % shape.skips
    pair = (contexts * 2654435761 % (1 << 32) >> 5) % shape.pairs
    base = 1 + shape.classes
    return [np.zeros_like(contexts), 1 + back, base + skip, base + shape.skips + pair]


def class_scores(contexts: np.ndarray, weights: np.ndarray, shape: Shape) -> np.ndarray:
    """Natural logarithm of the class probabilities in each context."""
    scores = sum(weights[f] for f in features(contexts, shape))
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


GRADIENT = pa.schema([("sums", pa.binary())])


def feature_sums(weights: np.ndarray | None, shape: Shape, rows: int):
    """Function for ``mapInArrow``: feature counts of a partition, expected under the weights.

    Without weights they are the observed ones. The difference of both is the gradient.
    """

    def run(batches):
        sums = np.zeros((rows, shape.classes))
        for batch in batches:
            context = column(batch, "context").to_numpy()
            kinds, n = column(batch, "kind").to_numpy(), column(batch, "n").to_numpy()
            present, row = np.unique(context, return_inverse=True)
            table = np.zeros((len(present), shape.classes))
            np.add.at(table, (row, kinds), n)
            if weights is not None:
                model = np.exp(class_scores(present, weights, shape))
                table = model * table.sum(1, keepdims=True)
            for f in features(present, shape):
                np.add.at(sums, f, table)
        yield batch_of(GRADIENT, sums=[sums.astype(np.float32).tobytes()])

    return run


def train(contexts: DataFrame, shape: Shape, parts: int = 4) -> np.ndarray:
    """Weights after ``rounds`` gradient passes over the partitions of the context table.

    A step divides a feature's gradient by its counts, which bounds it and lets rare features
    move as fast as frequent ones; ``prior`` keeps unseen ones near zero. A pass returns one
    table of feature sums per partition, whose size the shape bounds.
    """
    rows = 1 + shape.classes + shape.skips + shape.pairs
    contexts = materialize(contexts.repartition(parts, "context"), "lm-contexts")

    def summed(weights):
        done = contexts.mapInArrow(feature_sums(weights, shape, rows), "sums binary").collect()
        return sum(np.frombuffer(p.sums, np.float32).astype(float) for p in done).reshape(
            rows, shape.classes
        )

    observed = summed(None)
    weights = np.zeros((rows, shape.classes), np.float32)
    for _ in range(shape.rounds):
        expected = summed(weights)
        step = (observed - expected) / (observed + expected + 2 * shape.prior)
        weights = (weights + step).astype(np.float32)
    return weights


SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
SCORES_SQL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def scorer(table, sums, tokens, distinct, ended, shape: Shape):
    """Function for ``cogroup``: scores of a chunk's texts, given its words' counts."""
    totals, kinds_seen = sums

    def run(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        place = counts.column("place").to_numpy()
        known = np.zeros(len(place), np.float64)
        kinds = np.zeros(len(place), np.int64)
        known[place] = counts.column("n").to_numpy()
        kinds[place] = counts.column("kind").to_numpy()
        for row in chunk.to_pylist():
            here, back, skip, inner, codes, sizes, stops = streams(row, kinds, shape)
            base = np.log10((known + ADDED) / (tokens + ADDED * (distinct + 1)))
            within = np.log10((known + ADDED) / (totals[kinds] + ADDED * (kinds_seen[kinds] + 1)))
            base_end = np.log10((ended + ADDED) / (tokens + ADDED * (distinct + 1)))
            token_base = np.full(len(here), base_end)
            token_base[inner] = base[codes]
            token_score = table[back * shape.skips + skip, here].astype(np.float64)
            token_score[inner] += within[codes]
            token_known = np.full(len(here), int(ended > 0))
            token_known[inner] = known[codes] > 0
            firsts = stops - sizes
            out.append(
                batch_of(
                    SCORES,
                    doc_id=row["ids"],
                    held_out=[not t for t in row["trained"]],
                    n_tokens=sizes + 1,
                    n_known=np.add.reduceat(token_known, firsts),
                    base_score=np.add.reduceat(token_base, firsts),
                    score=np.add.reduceat(token_score, firsts),
                )
            )
        return pa.Table.from_batches(out, SCORES)

    return run


def score_documents(docs: DataFrame, parts: int = 10, shape: Shape = Shape()) -> DataFrame:
    """Log10 probability of every text under a model of the texts outside fold 0.

    Rows of ``docs`` (doc_id, text) whose crc32 fold is not 0 are learned from. Each row gives
    one row, repeated ids included: ``n_tokens`` counts words and one end, ``base_score`` is the
    smoothed unigram score, ``score`` the model's. A null or empty text is the end token alone.
    An empty table gives an empty result; without training texts all counts are 0. Other
    columns of ``docs`` are ignored. A null id keeps its row and its fold is that of ''.
    """
    spark = docs.sparkSession
    marked = texts(docs.withColumn("trained", fold(parts) != 0), "trained")
    chunks = materialize(marked.mapInArrow(tokenise, CHUNKS_SQL), "lm-chunks", STORED)

    places = chunks.select("chunk", "words", "counts").mapInArrow(vocabularies, PLACES_SQL)
    ended = chunks.agg(
        F.sum(F.expr("aggregate(trained, 0L, (n, t) -> n + cast(t AS long))"))
    ).first()[0] or 0
    dictionary = materialize(
        places.groupBy("word").agg(F.sum("n").alias("n")), "lm-dictionary"
    )
    learned = dictionary.where("n > 0")
    tokens, distinct = learned.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = (tokens or 0) + ended, distinct + int(ended > 0)
    frequent = [
        r.word for r in learned.orderBy(F.desc("n"), "word").limit(shape.frequent).collect()
    ]
    classed = dictionary.mapInArrow(
        classifier(frequent, shape), "word string, n long, kind smallint"
    )
    sums = (
        classed.where("n > 0")
        .groupBy("kind")
        .agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
        .collect()
    )
    totals, kinds_seen = np.zeros(shape.classes), np.zeros(shape.classes)
    for r in sums:
        totals[r.kind], kinds_seen[r.kind] = r.total, r.distinct

    contexts = (
        chunks.select("trained", "sizes", "wide", "codes", "words")
        .mapInArrow(context_counter(frequent, shape), "context long, kind long, n long")
        .groupBy("context", "kind")
        .agg(F.sum("n").alias("n"))
    )
    weights = train(contexts, shape)
    every = np.arange(shape.classes * shape.skips)
    table = (class_scores(every, weights, shape) / np.log(10)).astype(np.float32)

    counted = (
        places.select("chunk", "place", "word")
        .join(classed, "word")
        .select(F.col("chunk").alias("of_chunk"), "place", "n", "kind")
    )
    scored = (
        chunks.select("chunk", "ids", "trained", "sizes", "wide", "codes")
        .groupBy("chunk")
        .cogroup(counted.groupBy("of_chunk"))
        .applyInArrow(
            scorer(table, (totals, kinds_seen), tokens, distinct, ended, shape),
            SCORES_SQL,
        )
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
