"""Scores of the maximum-entropy model against a dense reference, token by token."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from filetally.llm import language_model as module
from filetally.llm.language_model import END, Shape, class_scores, score_documents, word_classes

from .conftest import prose
from .test_models import crc, lm_words

SHAPE = Shape(frequent=5, endings=4, skips=3, pairs=16, rounds=4)


@pytest.fixture(scope="module")
def trained(docs):
    """Scores of a small corpus, and the weights they were made with."""
    kept = {}
    train = module.train

    def watched(contexts, shape, parts=4):
        kept["counts"] = [tuple(r) for r in contexts.collect()]
        kept["weights"] = train(contexts, shape, parts)
        return kept["weights"]

    patch = pytest.MonkeyPatch()
    patch.setattr(module, "train", watched)
    rows = [(k, prose(k % 30, 5 + k % 25)) for k in range(120)] + [(200, None), (201, "One unseen")]
    try:
        found = {r.doc_id: r for r in score_documents(docs(*rows), shape=SHAPE).collect()}
    finally:
        patch.undo()
    return rows, found, kept


def classes_of(rows):
    counts = Counter(w for i, t in rows if crc(i) % 10 for w in lm_words(t))
    plain = {w: n for w, n in counts.items() if w != END}
    frequent = sorted(plain, key=lambda w: (-plain[w], w))[: SHAPE.frequent]

    def kind(word):
        return int(word_classes(pa.array([word], pa.string()), frequent, SHAPE)[0])

    return counts, kind


def contexts_of(kinds):
    """Context of each token: the class before, and the bucket of the one before that."""
    out, back, skip = [], 0, 0
    for k in kinds:
        out.append(back * SHAPE.skips + skip % SHAPE.skips)
        skip, back = back, k
    return out


def test_the_gradient_table_counts_every_training_token(trained):
    rows, _, kept = trained
    _, kind = classes_of(rows)
    expected = Counter()
    for i, text in rows:
        if crc(i) % 10:
            kinds = [kind(w) for w in lm_words(text)]
            expected.update(zip(contexts_of(kinds), kinds, strict=True))
    assert {(c, k): n for c, k, n in kept["counts"]} == dict(expected)


def test_scores_equal_a_dense_reference_and_sum_to_one(trained):
    rows, found, kept = trained
    counts, kind = classes_of(rows)
    kinds = {w: kind(w) for w in counts}
    total, distinct = defaultdict(int), defaultdict(int)
    for w, n in counts.items():
        if w != END:
            total[kinds[w]] += n
            distinct[kinds[w]] += 1
    weights = kept["weights"].astype(float)

    def class_probabilities(context):
        """From the four rows of the weight table that the context makes active."""
        back, skip = divmod(context, SHAPE.skips)
        pair = (context * 2654435761 % (1 << 32) >> 5) % SHAPE.pairs
        base = 1 + SHAPE.classes
        scores = sum(weights[r] for r in (0, 1 + back, base + skip, base + SHAPE.skips + pair))
        odds = np.exp(scores - scores.max())
        return odds / odds.sum()

    def within(word, k):
        return (counts[word] + 0.1) / (total[k] + 0.1 * (distinct[k] + 1))

    for i, text in rows:
        words = lm_words(text)
        own = [kind(w) for w in words]
        expected = 0.0
        for w, k, context in zip(words, own, contexts_of(own), strict=True):
            p = class_probabilities(context)[k]
            expected += math.log10(p) + (0 if w == END else math.log10(within(w, k)))
        assert found[i].score == pytest.approx(expected, abs=1e-4)

    for context in range(SHAPE.classes * SHAPE.skips):
        p = class_probabilities(context)
        assert np.exp(class_scores(np.array([context]), kept["weights"], SHAPE)).sum() == pytest.approx(1)
        mass = p[0]  # the end
        for k in range(1, SHAPE.classes):
            known = sum(within(w, k) for w in counts if w != END and kinds[w] == k)
            unseen = 0.1 / (total[k] + 0.1 * (distinct[k] + 1))
            mass += p[k] * (known + unseen)  # one word of each class that was never seen
        assert mass == pytest.approx(1)
