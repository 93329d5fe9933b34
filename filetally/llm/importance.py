"""Target-distribution importance resampling: array-scored weights and a distributed quickselect.

A document's features are its runs of one to three words, hashed by ``crc32`` into buckets. Two
count arrays, of all documents and of the target texts, give one gain per bucket; a document's
weight is the sum over its features, looked up in that array. Adding noise of the Gumbel
distribution to the weight turns "the k highest" into a draw without replacement.

The k-th highest composite key is found by quickselect: random pivot keys, one aggregate that
counts what lies below, at and above each of them, and the interval that holds the k-th key is
searched again. Only the winners are sorted, by ranges, and ranked by the sizes of the ranges
before theirs. What reaches the driver is two arrays of ``BUCKETS`` counts, ``PIVOTS`` keys a
round and one count a range, whatever the size of the corpus.

Checksums of word runs are combined, not computed anew: appending n bytes to a text multiplies
its checksum by a fixed matrix, kept as lookup tables for n up to ``LONG``.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import materialize, texts
from filetally.llm.text import LOWER, batch_of, buffer_of, column, runs, word_bounds

BUCKETS = 10_000
ORDERS = 3  # words of the longest feature
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
PIVOTS = 16
PIECE = 1 << 20
LONG = 64  # bytes up to which checksums advance by one lookup

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _byte_table() -> np.ndarray:
    """Effect of one byte on a checksum register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


def _advance_tables(byte: np.ndarray) -> np.ndarray:
    """``[n, j, b]``: register ``b << 8j`` after n zero bytes."""
    tables = np.empty((LONG + 1, 4, 256), np.uint32)
    for j in range(4):
        tables[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    for n in range(LONG):
        tables[n + 1] = byte[tables[n] & 255] ^ (tables[n] >> np.uint32(8))
    return tables


BYTE = _byte_table()
ADVANCE = _advance_tables(BYTE)


def advanced(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What a checksum contributes once ``size`` more bytes follow."""
    crc, size = crc.copy(), size.copy()
    while True:
        step = np.minimum(size, LONG)
        moved = ADVANCE[step, 0, crc & 255]
        for j in range(1, 4):
            moved = moved ^ ADVANCE[step, j, (crc >> np.uint32(8 * j)) & 255]
        crc, size = moved, size - step
        far = np.flatnonzero(size)
        if not len(far):
            return crc
        crc[far] = advanced(crc[far], size[far])
        return crc


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``crc32`` of ``data[start:end]`` for each pair, byte by byte over all words at once."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at = starts[order]
    register = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longest = size[order]
    for k in range(int(min(longest[0], LONG)) if len(order) else 0):
        active = int(np.searchsorted(-longest, -k, "left"))  # words of more than k bytes
        now = register[:active]
        register[:active] = BYTE[(now ^ data[at[:active] + k]) & 255] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = register ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def features(data: np.ndarray, bounds: np.ndarray):
    """Bucket of the feature of each order that ends at each word, ``BUCKETS`` where there is
    none, and the number of words before each text."""
    starts, ends = word_bounds(data, bounds, SEPARATOR)
    before = np.searchsorted(starts, bounds)
    place = np.arange(len(starts)) - np.repeat(before[:-1], np.diff(before))
    size = ends - starts
    single = checksums(LOWER[data], starts, ends)
    blank = np.full(len(single), zlib.crc32(b" "), np.uint32)
    spaced = advanced(blank, size) ^ single
    found = np.full((ORDERS, len(single)), BUCKETS, np.int64)
    crc = single
    for k in range(ORDERS):
        if k:  # the run that ended one word earlier, a blank and this word
            crc = np.concatenate([single[:1], advanced(crc[:-1], size[1:] + 1) ^ spaced[1:]])
        has = place >= k
        found[k, has] = crc[has] % BUCKETS
    return found, before


def each_piece(batches):
    """Features of the texts of a stream of batches: ``(batch, first, end, found, before)``."""
    for batch in batches:
        data, bounds = buffer_of(column(batch, "text"))
        for first, end in runs(bounds, PIECE):
            low = bounds[first]
            found, before = features(data[low : bounds[end]], bounds[first : end + 1] - low)
            yield batch, first, end, found, before


COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def counted(batches):
    """Features per bucket of one task's texts."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for _, _, _, found, _ in each_piece(batches):
        total += np.bincount(found.ravel(), minlength=BUCKETS + 1)
    filled = np.flatnonzero(total[:BUCKETS])
    yield batch_of(COUNTS, bucket=filled.astype(np.int32), n=total[filled])


def bucket_counts(table: DataFrame) -> list[int]:
    """Features of all texts of ``table`` per bucket."""
    rows = table.select("text").mapInArrow(counted, "bucket int, n long")
    counts = [0] * BUCKETS
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """Gain of each bucket, in thousandths of a natural logarithm, rounded down."""
    s, t = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log(((b + 1) * s) / ((a + 1) * t)))
            for a, b in zip(source, target, strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None) -> int:
    """Gumbel noise of a document, in thousandths, from the digest of the seed and its id."""
    named = f"{SEED}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(named).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


WEIGHTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_features", pa.int64()),
        ("weight", pa.int64()),
        ("score", pa.int64()),
    ]
)
WEIGHTS_SQL = "doc_id long, n_words long, n_features long, weight long, score long"


def weigher(gain: np.ndarray):
    """Function for ``mapInArrow``: measures, weight and score of each document."""
    table = np.append(gain, 0)  # the last entry is of words that end no feature of an order

    def run(batches):
        for batch, first, end, found, before in each_piece(batches):
            upto = np.concatenate([[0], np.cumsum(table[found].sum(axis=0))])
            words = np.diff(before)
            ids = column(batch, "doc_id").slice(first, end - first)
            weight = np.diff(upto[before])
            drawn = np.array([noise(i) for i in ids.to_pylist()], np.int64)
            yield batch_of(
                WEIGHTS,
                doc_id=ids,
                n_words=words,
                n_features=sum(np.maximum(words - k, 0) for k in range(ORDERS)),
                weight=weight,
                score=weight + drawn,
            )

    return run


KEY = ("below", "nameless", "id", "row")  # highest score, then smallest id; rows are distinct


def _keyed(scored: DataFrame) -> DataFrame:
    return scored.selectExpr(
        "*", "-score AS below", "doc_id IS NULL AS nameless", "coalesce(doc_id, 0) AS id"
    )


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(KEY, key, strict=True)])


def kth_key(keyed: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The k-th smallest key (from 1) of a table that has at least k rows.

    Each round draws keys of the interval at random, counts the rows below and at each by one
    aggregate, and goes on in the interval between two of them. Any draw leads to the same key.
    """
    key = F.struct(*KEY)
    low = high = None
    passed = 0  # rows at or below ``low``
    while True:
        inside = keyed
        if low is not None:
            inside = inside.where(key > _literal(low))
        if high is not None:
            inside = inside.where(key < _literal(high))
        drawn = inside.select(*KEY).orderBy(F.rand()).limit(pivots).collect()
        drawn = sorted(tuple(r) for r in drawn)
        sides = [
            F.sum(side.cast("long"))
            for p in drawn
            for side in (key < _literal(p), key == _literal(p))
        ]
        counts = inside.agg(*sides).first()
        reached = passed
        for j, pivot in enumerate(drawn):
            below, same = counts[2 * j], counts[2 * j + 1]
            if passed + below >= k:
                high = pivot
                break
            if passed + below + same >= k:
                return pivot
            low, reached = pivot, passed + below + same
        passed = reached


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their rank: sorted by ranges, each range shifted by those before it."""
    spark = winners.sparkSession
    placed = materialize(
        winners.repartitionByRange(*KEY)
        .sortWithinPartitions(*KEY)
        .withColumn("slot", F.monotonically_increasing_id()),
        "importance-winners",
    )
    part = F.shiftright("slot", 33)
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    offsets, total = [], 0
    for number, size in sizes:  # one entry a range, not a row
        offsets.append((number, total))
        total += size
    shift = F.broadcast(spark.createDataFrame(offsets, "part long, shift long"))
    place = F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(shift, "part").withColumn("rank", F.col("shift") + place + 1)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """Draw ``percent`` of the documents of enough words, likelier the more they read like ``target``.

    Columns: doc_id, n_words, n_features, weight, score and rank (1 is the highest score, null
    if not drawn), one row for each row of ``docs`` (doc_id, text). Null and empty texts have no
    features and weigh 0; they count towards no draw unless ``least_words`` is 0. Very long
    texts are taken whole. Equal scores rank by the smaller doc_id, a null id last; rows that
    repeat an id are rows of their own, and between rows equal in score and id the order is
    that of their first writing. An empty target weighs by rarity alone, an empty table gives
    no rows. Of ``docs`` only doc_id and text are read and of ``target`` only text, so other
    columns cannot clash.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = materialize(
        texts(docs)
        .mapInArrow(weigher(gain), WEIGHTS_SQL)
        .withColumn("row", F.monotonically_increasing_id()),
        "importance-weights",
    )
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * percent // 100
    kept = [f.name for f in WEIGHTS]
    if drawn == 0:
        return scored.select(*kept, F.lit(None).cast("long").alias("rank"))
    keyed = _keyed(scored)
    last = _literal(kth_key(keyed.where(eligible), drawn))
    wins = eligible & (F.struct(*KEY) <= last)
    winners = ranked(keyed.where(wins)).select(*kept, "rank")
    others = keyed.where(~wins).select(*kept, F.lit(None).cast("long").alias("rank"))
    return winners.unionByName(others)


SQL = r"""
WITH bytes AS (
  SELECT list(r ORDER BY b) AS crc_table FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, k:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS r
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
doc_words AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', NULL, -row_number() OVER (), regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT side, r, array_to_string(w[i:i + k], ' ') AS g
  FROM (SELECT side, r, w, k, unnest(range(1, len(w) - k + 1)) AS i
        FROM doc_words, (SELECT unnest(range(3)) AS k))),
hashed AS (
  SELECT g, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      range(1, strlen(g) + 1), lambda i: CAST(
        (instr('0123456789ABCDEF', hex(g)[2 * i - 1]) - 1) * 16
        + instr('0123456789ABCDEF', hex(g)[2 * i]) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM grams), bytes),
found AS (SELECT side, r, bucket FROM grams JOIN hashed USING (g)),
totals AS (
  SELECT count(*) FILTER (side = 'd') AS s_all, count(*) FILTER (side = 'b') AS t_all FROM found),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (CAST(count(*) FILTER (side = 'b') + 1 AS DOUBLE) * CAST(any_value(s_all) + 10000 AS DOUBLE))
    / (CAST(count(*) FILTER (side = 'd') + 1 AS DOUBLE) * CAST(any_value(t_all) + 10000 AS DOUBLE))
  )) AS BIGINT) AS gain FROM found, totals GROUP BY bucket),
weights AS (
  SELECT r, count(*) AS n_features, sum(gain) AS weight
  FROM found JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, r, coalesce(n_features, 0) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(
      concat('0x', left(sha256(concat('42:', CAST(id AS VARCHAR))), 8)) AS BIGINT) + 0.5)
      / 4294967296.0))) AS BIGINT) AS score
  FROM doc_words LEFT JOIN weights USING (r) WHERE side = 'd'),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored WHERE n_words >= 20),
quota AS (SELECT 5 * count(*) // 100 AS quota FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN place <= quota THEN place END AS rank
FROM scored LEFT JOIN drawn USING (r), quota
"""
