"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are rates over the whole text: words of the abuse lexicon and their variety, the
same after undoing obfuscation (digits and signs for letters, marks inside words), abuse near
the second person, the densest stretch, capitals, exclamation and repeated punctuation.

A hand-written list knows few languages, so a second lexicon is learned from the labelled
texts: words, and beginnings of words, weighted by a lower bound of the log-odds of standing in
a toxic text. Its density, count and largest weight are features like the others. A training
text is measured by a lexicon learned from the other three of four parts, so none is scored by
its own label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import fold, materialize, texts
from filetally.llm.sample import LIMIT, labelled_texts
from filetally.llm.text import (
    LOWER,
    SPACE,
    batch_of,
    buffer_of,
    column,
    fingerprints,
    runs,
    word_bounds,
)

PIECE = 1 << 18
NEAR = 5  # words between an insult and a second-person word
STRETCH = 64  # words of the densest stretch
PARTS = 4  # of the labelled texts, for the learned lexicon
BEGINNING = 5  # bytes of a word's beginning
LEAST_TEXTS = 3  # toxic texts that a learned entry stands in
LEAST_WEIGHT = 0.5  # of a learned entry
ERRORS = 1.5  # standard errors by which its log-odds are lowered

# Word lists: insults and contempt, and the second person, in the corpus languages.
ABUSE = """
    idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile cretin fool loser losers
    trash garbage scum scumbag vermin filth filthy disgusting pathetic worthless useless clown
    clowns pig pigs rat rats jerk freak creep bastard bastards bitch asshole shit bullshit crap
    fuck fucking fucked damn hate kill ugly retard retarded slut whore
    arschloch scheisse scheiße dreck abschaum dummkopf trottel blödmann miststück schlampe wichser
    connard connasse salaud salope merde ordure crétin abruti débile pute
    idiota imbécil estúpido estúpida basura mierda cabrón puta gilipollas asqueroso escoria
""".split()
SECOND_PERSON = """
    you your yours you're youre yourself u ur du dich dir dein deine euch ihr
    tu toi te ton vous votre usted ustedes tú ti vosotros
""".split()

# Signs that stand for letters when a word is disguised.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
SIGN = ~(LETTER | SPACE)
SIGN[48:58] = False
PLAIN_KEPT = LETTER | SPACE
OPENED = LOWER.copy()
OPENED_KEPT = PLAIN_KEPT.copy()
for sign, letter in DISGUISES.items():
    OPENED[ord(sign)] = ord(letter)
    OPENED_KEPT[ord(sign)] = True

FEATURES = [
    "abuse_rate",
    "abuse_words",
    "abuse_kinds",
    "opened_rate",
    "disguised_rate",
    "near_rate",
    "second_rate",
    "densest",
    "capital_rate",
    "shout_rate",
    "exclaim_rate",
    "question_rate",
    "sign_rate",
    "repeat_rate",
    "inner_sign_rate",
    "log_words",
    "learned_rate",
    "learned_words",
    "learned_most",
    "begun_rate",
    "begun_words",
    "begun_most",
]


def lexicon(entries: list[str]) -> np.ndarray:
    """Sorted fingerprints of a word list."""
    data, bounds = buffer_of(pa.array(entries, pa.string()))
    return np.sort(np.unique(fingerprints(data, bounds[:-1], bounds[1:])))


def member(hashes: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted entries, or -1."""
    at = np.minimum(np.searchsorted(entries, hashes), len(entries) - 1)
    return np.where(entries[at] == hashes, at, -1)


def reduced(data, starts, ends, keep, fold):
    """Fingerprints of words without the bytes that ``keep`` leaves out."""
    kept = keep[data]
    upto = np.concatenate([[0], np.cumsum(kept)])
    return fingerprints(data[kept], upto[starts], upto[ends], fold)


@dataclass
class Learned:
    """Sorted fingerprints of words, or of their beginnings, and their weights."""

    words: tuple[np.ndarray, np.ndarray]
    beginnings: tuple[np.ndarray, np.ndarray]


NOTHING = (np.zeros(0, np.uint64), np.zeros(0))


def terms(data, starts, ends):
    """Fingerprints of the letters of each word, and of the first of them."""
    kept = PLAIN_KEPT[data]
    upto = np.concatenate([[0], np.cumsum(kept)])
    low, high = upto[starts], upto[ends]
    letters = data[kept]
    whole = fingerprints(letters, low, high)
    return whole, fingerprints(letters, low, np.minimum(high, low + BEGINNING))


def weight_of(hashes: np.ndarray, entries: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Weight of each hash, 0 if it is no entry."""
    if not len(entries[0]):
        return np.zeros(len(hashes))
    at = member(hashes, entries[0])
    return np.where(at >= 0, entries[1][at], 0.0)


def measure(data, bounds, abuse, second, learned: Learned) -> np.ndarray:
    """Feature rows of the texts of one piece."""
    count = len(bounds) - 1
    starts, ends = word_bounds(data, bounds)
    before = np.searchsorted(starts, bounds)
    total = np.diff(before)
    owner = np.repeat(np.arange(count), total)
    whole, beginning = terms(data, starts, ends)
    plain = member(whole, abuse)
    opened = member(reduced(data, starts, ends, OPENED_KEPT, OPENED), abuse)
    hit, open_hit = plain >= 0, (plain >= 0) | (opened >= 0)
    you = member(whole, second) >= 0

    def per(flags):
        return np.bincount(owner, flags, minlength=count)

    def chars(flags):
        upto = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(upto[bounds]).astype(float)

    upto = np.concatenate([[0], np.cumsum(you)])
    index = np.arange(len(owner))
    low = np.maximum(index - NEAR, before[owner]) if len(owner) else index
    high = np.minimum(index + NEAR + 1, before[owner + 1]) if len(owner) else index
    near = open_hit & (upto[high] > upto[low])
    upto = np.concatenate([[0], np.cumsum(open_hit)])
    high = np.minimum(index + STRETCH, before[owner + 1]) if len(owner) else index
    densest = np.zeros(count)
    np.maximum.at(densest, owner, upto[high] - upto[index])
    kinds = np.unique(owner[open_hit] * 4096 + np.maximum(plain, opened)[open_hit]) // 4096
    solid, upper, sign = ~SPACE[data], UPPER[data], SIGN[data]
    letters = LETTER[data]
    caps = np.concatenate([[0], np.cumsum(upper)])
    lets = np.concatenate([[0], np.cumsum(letters)])
    length = lets[ends] - lets[starts]
    shout = (length >= 3) & (caps[ends] - caps[starts] == length)
    again = np.zeros(len(data), dtype=bool)
    again[1:] = sign[1:] & (data[1:] == data[:-1])
    inner = np.zeros(len(data), dtype=bool)
    inner[1:-1] = sign[1:-1] & letters[:-2] & letters[2:]
    filled = np.diff(bounds) > 0  # what touches another text is no neighbour
    firsts, lasts = bounds[:-1][filled], bounds[1:][filled] - 1
    again[firsts] = inner[firsts] = inner[lasts] = False
    size = np.maximum(chars(solid), 1)
    n = np.maximum(total, 1)
    odds = []
    for weight in (weight_of(whole, learned.words), weight_of(beginning, learned.beginnings)):
        most = np.zeros(count)
        np.maximum.at(most, owner, weight)
        odds += [per(weight) / n, per(weight > 0), most]
    return np.column_stack(
        [
            per(hit) / n,
            per(open_hit),
            np.bincount(kinds, minlength=count),
            per(open_hit) / n,
            per(open_hit & ~hit) / n,
            per(near) / n,
            per(you) / n,
            densest,
            chars(upper) / np.maximum(chars(letters), 1),
            per(shout) / n,
            chars(data == ord("!")) / size,
            chars(data == ord("?")) / size,
            chars(sign) / size,
            chars(again) / size,
            chars(inner) / size,
            np.log1p(total),
            *odds,
        ]
    )


def matrix_of(batch: pa.RecordBatch, abuse, second, learned: Learned) -> np.ndarray:
    """Feature rows of a batch of texts."""
    data, bounds = buffer_of(column(batch, "text"))
    parts = [np.zeros((0, len(FEATURES)))]
    for first, end in runs(bounds, PIECE):
        low = bounds[first]
        piece = data[low : bounds[end]], bounds[first : end + 1] - low
        parts.append(measure(*piece, abuse, second, learned))
    return np.concatenate(parts)


@dataclass
class Trees:
    """Boosted trees of fixed depth: node arrays, root first, leaves last."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                right = x[np.arange(len(x)), feature[node]] > cut[node]
                node = 2 * node + 1 + right
            out += value[node - len(feature)]
        return out


def boost(x, y, rounds=60, depth=3, rate=0.15, bins=48, ridge=1.0) -> Trees:
    """Logistic boosting on histograms of quantile bins, second-order gains."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    rate_of = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate_of / (1 - rate_of)))
    margin = np.full(len(y), start)
    inner = 2**depth - 1
    trees = ([], [], [])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            low = 2**level - 1
            width = 2**level
            local = node - low
            best = np.full(width, 1e-6)
            place = np.full(width, -1)
            gs, hs = np.bincount(local, g, width), np.bincount(local, h, width)
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                key = local * (bins + 1) + binned[:, f]
                gl = np.bincount(key, g, width * (bins + 1)).reshape(width, -1).cumsum(1)
                hl = np.bincount(key, h, width * (bins + 1)).reshape(width, -1).cumsum(1)
                gr, hr = gs[:, None] - gl, hs[:, None] - hl
                gain = (
                    gl**2 / (hl + ridge)
                    + gr**2 / (hr + ridge)
                    - (gs**2 / (hs + ridge))[:, None]
                )[:, : len(cuts[f])]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                place[better] = k[better]
                feature[low : low + width][better] = f
            for j in np.flatnonzero(place >= 0):
                cut[low + j] = cuts[feature[low + j]][place[j]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        margin += value[leaf]
        for kept, new in zip(trees, (feature, cut, value), strict=True):
            kept.append(new)
    return Trees(start, *(np.array(t) for t in trees))


def isotonic(scores, y) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step fit of ``y`` on ``scores`` (pool adjacent violators)."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(scores[order], y[order], strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    knots = [(b[2], b[0] / b[1]) for b in blocks] + [(b[3], b[0] / b[1]) for b in blocks]
    knots.sort()
    return np.array([k for k, _ in knots]), np.array([v for _, v in knots])


@dataclass
class Model:
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]
    learned: Learned

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(x), *self.knots)


def fit(x: np.ndarray, y: np.ndarray, learned: Learned) -> Model | None:
    """Trees on three rows of four, calibration on the fourth; None without both labels."""
    if len(np.unique(y)) < 2:
        return None
    rest = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[rest])) < 2 or len(np.unique(y[~rest])) < 2:
        rest = np.zeros(len(y), dtype=bool)
    trees = boost(x[~rest], y[~rest])
    held = rest if rest.any() else ~rest
    return Model(trees, isotonic(trees.margin(x[held]), y[held].astype(float)), learned)


TERMS = pa.schema(
    [
        ("kind", pa.int32()),  # 0 words, 1 beginnings
        ("term", pa.int64()),
        ("part", pa.int32()),
        ("toxic", pa.int64()),
        ("clean", pa.int64()),
    ]
)
TERMS_SQL = "kind int, term long, part int, toxic long, clean long"


def counted_terms(batches):
    """How many toxic and clean texts of each part have each term."""
    for batch in batches:
        data, bounds = buffer_of(column(batch, "text"))
        label = column(batch, "label").to_numpy()
        part = column(batch, "part").to_numpy().astype(np.int64)
        for first, end in runs(bounds, PIECE):
            low = bounds[first]
            piece, inner = data[low : bounds[end]], bounds[first : end + 1] - low
            starts, ends = word_bounds(piece, inner)
            owner = first + np.searchsorted(inner, starts, "right") - 1
            for kind, hashes in enumerate(terms(piece, starts, ends)):
                order = np.lexsort((owner, hashes))
                term, text = hashes[order], owner[order]
                once = np.ones(len(term), dtype=bool)
                once[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
                term, text = term[once], text[once]
                key, code = np.unique(term, return_inverse=True)
                cell = code * PARTS + part[text]
                size = len(key) * PARTS
                toxic = np.bincount(cell, label[text] == 1, size).astype(np.int64)
                clean = np.bincount(cell, label[text] == 0, size).astype(np.int64)
                used = np.flatnonzero(toxic + clean)
                yield batch_of(
                    TERMS,
                    kind=np.full(len(used), kind, np.int32),
                    term=key[used // PARTS].view(np.int64),
                    part=(used % PARTS).astype(np.int32),
                    toxic=toxic[used],
                    clean=clean[used],
                )


def odds_of(toxic, clean, all_toxic, all_clean) -> np.ndarray:
    """Log-odds of a term in toxic against clean texts, less some standard errors."""
    toxic, clean = toxic + 0.5, clean + 0.5
    ratio = np.log(toxic / (all_toxic + 1)) - np.log(clean / (all_clean + 1))
    return ratio - ERRORS * np.sqrt(1 / toxic + 1 / clean)


def learned_lexicons(sample: DataFrame) -> list[Learned]:
    """Lexicon of all parts but one, for each part, and at the end that of all.

    Terms are counted where the texts are and added up by term. Only those that stand in
    ``LEAST_TEXTS`` toxic texts, and oftener than in clean ones, reach the driver; the sample
    is bounded, and so are they.
    """
    cells = [
        F.sum(F.when(F.col("part") == q, F.col(side)).otherwise(0)).alias(f"{side}{q}")
        for side in ("toxic", "clean")
        for q in range(PARTS)
    ]
    totals = sample.groupBy("label", "part").count().collect()
    texts_of = {side: np.zeros(PARTS) for side in (1, 0)}
    for row in totals:
        texts_of[row.label][row.part] += row["count"]
    toxic = sum(F.col(f"toxic{q}") for q in range(PARTS))
    clean = sum(F.col(f"clean{q}") for q in range(PARTS))
    oftener = toxic * float(texts_of[0].sum()) > clean * float(texts_of[1].sum())
    rows = (
        sample.mapInArrow(counted_terms, TERMS_SQL)
        .groupBy("kind", "term")
        .agg(*cells)
        .where((toxic >= LEAST_TEXTS) & oftener)
        .collect()
    )
    found = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2 + 2 * PARTS)
    found = found[np.argsort(found[:, 1].view(np.uint64), kind="stable")]
    out = []
    for left_out in [*range(PARTS), None]:
        use = [q for q in range(PARTS) if q != left_out]
        t = found[:, 2 : 2 + PARTS][:, use].sum(axis=1)
        c = found[:, 2 + PARTS :][:, use].sum(axis=1)
        weight = odds_of(t, c, texts_of[1][use].sum(), texts_of[0][use].sum())
        lists = []
        for kind in (0, 1):
            kept = (found[:, 0] == kind) & (t >= LEAST_TEXTS) & (weight >= LEAST_WEIGHT)
            lists.append((found[kept, 1].view(np.uint64), weight[kept]))
        out.append(Learned(*lists))
    return out


ROWS = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])


def measurer(lexicons: list[Learned]):
    """Function for ``mapInArrow``: features of each text by the lexicon of the other parts."""

    def run(batches):
        abuse, second = lexicon(ABUSE), lexicon(SECOND_PERSON)
        for batch in batches:
            part = column(batch, "part").to_numpy()
            for q in range(PARTS):
                own = batch.filter(pa.array(part == q))
                if own.num_rows:
                    rows = matrix_of(own, abuse, second, lexicons[q])
                    ids, label = column(own, "doc_id"), column(own, "label")
                    yield batch_of(ROWS, doc_id=ids, label=label, x=rows.tolist())

    return run


def learn(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> Model | None:
    """Model of at most ``limit`` labelled texts outside fold 0; their feature rows are collected."""
    part = (F.crc32(F.concat(F.lit("part "), F.col("doc_id").cast("string"))) % PARTS).cast("int")
    sample = materialize(
        labelled_texts(docs, labels, "toxic", limit).withColumn("part", part), "toxicity-sample"
    )
    lexicons = learned_lexicons(sample)
    rows = (
        sample.mapInArrow(measurer(lexicons), "doc_id long, label int, x array<double>")
        .groupBy("doc_id")  # an id with several texts counts once
        .agg(F.max(F.struct("label", "x")).alias("row"))
        .select("doc_id", "row.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    if not rows:
        return None
    return fit(np.array([r.x for r in rows]), np.array([r.label for r in rows]), lexicons[-1])


SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("score", pa.float64()),
        ("abuse_words", pa.int64()),
        ("abuse_rate", pa.float64()),
        ("near_rate", pa.float64()),
    ]
)
SCORES_SQL = (
    "doc_id long, held_out boolean, score double, abuse_words long, abuse_rate double, "
    "near_rate double"
)


def scorer(model: Model | None):
    """Function for ``mapInArrow``."""

    learned = Learned(NOTHING, NOTHING) if model is None else model.learned

    def run(batches):
        abuse, second = lexicon(ABUSE), lexicon(SECOND_PERSON)
        for batch in batches:
            x = matrix_of(batch, abuse, second, learned)
            score = np.zeros(len(x)) if model is None else model.probability(x)
            yield batch_of(
                SCORES,
                doc_id=column(batch, "doc_id"),
                held_out=column(batch, "held_out"),
                score=score,
                abuse_words=x[:, FEATURES.index("abuse_words")].astype(np.int64),
                abuse_rate=x[:, FEATURES.index("opened_rate")],
                near_rate=x[:, FEATURES.index("near_rate")],
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Toxicity of every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic).

    ``held_out`` marks fold 0, of which no label is learned. Each row gives one row, repeated
    ones included. Null and empty texts have all rates 0 and the score the model gives that,
    very long texts are measured whole; ties in a feature score alike. Without labels of both kinds every score is 0. Only
    ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    model = learn(texts(docs), labels, limit)
    marked = texts(docs.withColumn("held_out", fold(5) == 0), "held_out")
    return marked.mapInArrow(scorer(model), SCORES_SQL).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows of ``docs`` that the model does not call toxic, with all their columns.

    The verdict is taken where the row is, so nothing is shuffled; rows without id or text are
    judged like others.
    """
    model = learn(texts(docs), labels, limit)

    def run(batches):
        abuse, second = lexicon(ABUSE), lexicon(SECOND_PERSON)
        for batch in batches:
            if model is not None:
                score = model.probability(matrix_of(batch, abuse, second, model.learned))
                batch = batch.filter(pa.array(score < 0.5))
            yield batch

    return docs.mapInArrow(run, docs.schema)
