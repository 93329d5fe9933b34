"""Language ID: known words by their frequency per language, unseen ones by shorter n-grams.

Words are runs of letters, A-Z lower-cased. A word of the model scores the logarithm of its
frequency in each language. Any other word backs off to its character n-grams, longest first:
the first length of which an n-gram was seen scores the word by the mean of those seen. Words
and n-grams are counted exactly, by 64-bit fingerprints, and "seen" means at least once.

The classifier is fitted on about ``rows`` labelled texts of each language, picked by a hash, or
on all where there are fewer. That bounds the model, whatever the corpus, and by language, so
that rare ones are learned as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import fold, texts
from filetally.llm.text import batch_of, buffer_of, column, first_places, mix, runs, slices, words

CHUNK = 4 << 20
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[ord("A") : ord("Z") + 1] = False
NOT_LETTER[ord("a") : ord("z") + 1] = False
NOT_LETTER[128:] = False

UNKNOWN = "und"


@dataclass(frozen=True)
class Shape:
    rows: int = 5_000  # labelled texts of each language to learn from
    orders: tuple[int, ...] = (5, 4, 3, 2, 1)
    smoothing: float = 0.5


@dataclass
class Table:
    """Sorted fingerprints and the log frequency of each, by language."""

    hashes: np.ndarray
    scores: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each fingerprint, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


@dataclass
class Model:
    languages: list[str]
    words: Table
    grams: list[Table]  # by order
    orders: tuple[int, ...]


WORD_COUNTS = pa.schema([("word", pa.string()), ("tongue", pa.int32()), ("n", pa.int64())])


def word_counter(count: int):
    """Function for ``mapInArrow``: counts of (word, language number) by chunk."""

    def run(batches):
        for batch in batches:
            data, bounds = buffer_of(column(batch, "text"))
            tongue = column(batch, "tongue").to_numpy()
            for first, end in runs(bounds, CHUNK):
                low = bounds[first]
                part = data[low : bounds[end]]
                hashes, starts, ends, before = words(
                    part, bounds[first : end + 1] - low, space=NOT_LETTER
                )
                codes, kinds = pd.factorize(hashes)
                places = first_places(codes, len(kinds))
                cell = codes * count + np.repeat(tongue[first:end], np.diff(before))
                cells, n = np.unique(cell, return_counts=True)
                lower = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
                names = slices(lower, starts[places], ends[places])
                yield batch_of(
                    WORD_COUNTS,
                    word=names.take(pa.array(cells // count)),
                    tongue=(cells % count).astype(np.int32),
                    n=n,
                )

    return run


def gram_hashes(names: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Word number and fingerprint of every n-gram of the words, their bounds marked."""
    chars = np.frombuffer(("\n" + "\n".join(names) + "\n").encode("utf-32-le"), np.uint32)
    mark = chars == 10
    upto = np.concatenate([[0], np.cumsum(mark)])
    first = np.arange(max(0, len(chars) - order + 1))
    if order == 1:
        first = first[~mark]
    else:
        first = first[upto[first + order - 1] == upto[first + 1]]
    with np.errstate(over="ignore"):
        key = np.full(len(first), order, np.uint64)
        for k in range(order):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + chars[first + k])
    return upto[first + 1] - 1, key


GRAM_COUNTS = pa.schema(
    [("kind", pa.int32()), ("hash", pa.int64()), ("tongue", pa.int32()), ("n", pa.int64())]
)
GRAM_SQL = "kind int, hash long, tongue int, n long"


def gram_counter(count: int, orders: tuple[int, ...]):
    """Function for ``mapInArrow``: counts by fingerprint and language of dictionary rows.

    ``kind`` is the number of an order, or -1 for the words themselves.
    """

    def run(batches):
        for batch in batches:
            spelled = column(batch, "word")
            names = spelled.to_pylist()
            tongue = column(batch, "tongue").to_numpy().astype(np.int64)
            n = column(batch, "n").to_numpy()
            data, bounds = buffer_of(spelled)
            whole = words(data, bounds, space=NOT_LETTER)[0]
            found = [(-1, np.arange(len(names)), whole)]
            found += [(k, *gram_hashes(names, order)) for k, order in enumerate(orders)]
            for kind, owner, hashes in found:
                codes, kinds = pd.factorize(hashes)
                cell = codes * count + tongue[owner]
                total = np.bincount(cell, n[owner], len(kinds) * count)
                used = np.flatnonzero(total)
                yield batch_of(
                    GRAM_COUNTS,
                    kind=np.full(len(used), kind, np.int32),
                    hash=kinds[used // count].view(np.int64),
                    tongue=(used % count).astype(np.int32),
                    n=total[used].astype(np.int64),
                )

    return run


def sampled(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` texts of each language, or all of fewer, the same on every run."""
    sizes = labelled.groupBy("lang").count()
    share = sizes.selectExpr("lang AS of", f"least(1, {rows} / count) AS share")
    share = F.broadcast(share)  # one row a language
    dice = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.join(share, F.expr("lang = of")).where(dice < F.col("share"))


def learn(labelled: DataFrame, shape: Shape = Shape()) -> Model | None:
    """Model of the texts of ``labelled`` (doc_id, text, lang); None without a usable row.

    Words and n-grams of the sampled texts are counted by Spark and collected, as are the
    languages; the sample bounds the former, being classes to choose from the latter.
    """
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r.lang for r in labelled.select("lang").distinct().collect())
    if not languages:
        return None
    count = len(languages)
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    dictionary = (
        sampled(labelled, shape.rows)
        .select("text", number.cast("int").alias("tongue"))
        .mapInArrow(word_counter(count), "word string, tongue int, n long")
        .groupBy("word", "tongue")
        .agg(F.sum("n").alias("n"))
    )
    counts = (
        dictionary.mapInArrow(gram_counter(count, shape.orders), GRAM_SQL)
        .groupBy("kind", "hash", "tongue")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    kind, hashes, tongue, n = (counts.column(c).to_numpy() for c in ("kind", "hash", "tongue", "n"))
    tables = []
    for k in range(-1, len(shape.orders)):
        own = kind == k
        found, code = np.unique(hashes[own].view(np.uint64), return_inverse=True)
        cells = np.zeros((len(found), count))
        cells[code, tongue[own]] = n[own]
        each = cells.sum(axis=0) + shape.smoothing * (len(found) + 1)
        tables.append(Table(found, np.log((cells + shape.smoothing) / each).astype(np.float32)))
    return Model(languages, tables[0], tables[1:], shape.orders)


def word_scores(hashes: np.ndarray, names: pa.Array, model: Model) -> np.ndarray:
    """Score of each distinct word by language; a word without any seen n-gram scores 0."""
    out = np.zeros((len(hashes), len(model.languages)), np.float64)
    at = model.words.find(hashes)
    found = at >= 0
    out[found] = model.words.scores[at[found]]
    rest = np.flatnonzero(~found)
    for table, order in zip(model.grams, model.orders, strict=True):
        if not len(rest):
            break
        owner, grams = gram_hashes(names.take(pa.array(rest)).to_pylist(), order)
        at = table.find(grams)
        owner, at = owner[at >= 0], at[at >= 0]
        hits = np.bincount(owner, minlength=len(rest))
        for j in range(len(model.languages)):
            sums = np.bincount(owner, weights=table.scores[at, j], minlength=len(rest))
            out[rest, j] = np.where(hits > 0, sums / np.maximum(hits, 1), out[rest, j])
        rest = rest[hits == 0]
    return out


PREDICTIONS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
    ]
)
PREDICTIONS_SQL = "doc_id long, held_out boolean, lang_pred string, score double"


def predictor(model: Model | None):
    """Function for ``mapInArrow``: language and its posterior for every text."""

    def run(batches):
        for batch in batches:
            data, bounds = buffer_of(column(batch, "text"))
            lettered = column(batch, "lettered").to_numpy(zero_copy_only=False).astype(bool)
            names, best = [], []
            for first, end in runs(bounds, CHUNK):
                low = bounds[first]
                part = data[low : bounds[end]]
                if model is None:
                    names += [UNKNOWN] * (end - first)
                    best += [0.0] * (end - first)
                    continue
                hashes, starts, ends, before = words(
                    part, bounds[first : end + 1] - low, space=NOT_LETTER
                )
                codes, kinds = pd.factorize(hashes)
                places = first_places(codes, len(kinds))
                lower = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
                spelled = slices(lower, starts[places], ends[places])
                scores = word_scores(kinds, spelled, model)
                total = np.zeros((end - first, len(model.languages)))
                owner = np.repeat(np.arange(end - first), np.diff(before))
                for j in range(len(model.languages)):
                    total[:, j] = np.bincount(owner, scores[codes, j], minlength=end - first)
                total -= total.max(axis=1, keepdims=True)
                likely = np.exp(total)
                likely /= likely.sum(axis=1, keepdims=True)
                pick = likely.argmax(axis=1)
                rows = lettered[first:end]
                names += [model.languages[p] if ok else UNKNOWN for p, ok in zip(pick, rows, strict=True)]
                best += np.where(rows, likely[np.arange(len(pick)), pick], 0.0).tolist()
            yield batch_of(
                PREDICTIONS,
                doc_id=column(batch, "doc_id"),
                held_out=column(batch, "held_out"),
                lang_pred=names,
                score=best,
            )

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, held_out, text).

    Each row gives one row, repeated ones included. A null text and one without a letter (empty
    ones among them) are ``und`` with score 0, as is everything without a model. Equal scores
    go to the language first in alphabetical order. Texts and words are never cut, whatever
    their length, an empty table gives no rows, and only the named columns are read, so others
    cannot clash.
    """
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", "held_out", "text", lettered).mapInArrow(
        predictor(model), PREDICTIONS_SQL
    )


def identify_languages(docs: DataFrame, parts: int = 3, shape: Shape = Shape()) -> DataFrame:
    """Learn from the rows outside fold 1 and predict all rows of ``docs`` (doc_id, text, lang)."""
    marked = texts(docs.withColumn("held_out", fold(parts) == 1), "lang", "held_out")
    return identify(marked, learn(marked.where("NOT held_out"), shape))
