"""Benchmark decontamination: prefix-filtered set join with exact containment of windows.

A window is 13 consecutive words of a benchmark item, or the whole of a shorter item. Its
shingles (``SHINGLE`` words, or the whole of a shorter window) are ordered by how rare they are
in the documents. Containment needs every shingle, so the rarest alone is a sufficient prefix:
only where a document has it can the window occur, at one known offset. Length and positional
bounds drop windows that would reach over the text's ends; what is left is held against the
shingles that cover the window, word for word.

Documents are read and tokenised once. That pass writes one row per document and one per
shingle of the benchmark found in it, with its place; the words are compared there, so a
shingle's number stands for its words. Everything after works on these narrow rows. The
benchmark's shingles are broadcast up to a number, and beyond it joined by a shuffle.

The outer forms of explode are used because the plain ones have Spark add a filter on the
array's size, which repeats the tokenisation for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetally.llm.common import materialize, texts

WINDOW = 13
SHINGLE = 5
MOST_BROADCAST = 200_000  # shingles of the benchmark; 200 bytes each at five usual words
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what no word has
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased; plain ASCII takes the faster function with equal result.

    Splitting between words costs a fraction of extracting them, which copies the text's rest.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), BETWEEN), "")


def shingle_hash(hashes: str, at: str, size: int) -> str:
    """Hash of ``size`` words from ``at`` on, out of the hashes of the words."""
    return f"xxhash64({', '.join(f'{hashes}[{at} + {k}]' for k in range(size))})"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``(window, item, words)``: the windows of each item, each named by its digest."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0))))
    return (
        items.withColumn("start", starts)
        .select("item", F.slice("words", F.col("start") + 1, F.lit(WINDOW)).alias("words"))
        .select(F.sha2(F.array_join("words", " "), 256).alias("window"), "item", "words")
        .distinct()
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """``(window, length, offset, wanted)``: the shingles of each window, in order."""
    size = f"least(size(words), {SHINGLE})"
    return (
        windows.select("window", "words")
        .distinct()
        .selectExpr(
            "window",
            "size(words) AS length",
            f"posexplode(transform(sequence(1, size(words) - {size} + 1),"
            f" i -> slice(words, i, {size}))) AS (offset, wanted)",
        )
    )


def numbered(shingles: DataFrame) -> DataFrame:
    """``(sid, size, hash, wanted)``: distinct shingles, numbered."""
    hashes = "transform(wanted, w -> xxhash64(w))"
    by_size = " ".join(
        f"WHEN {k} THEN {shingle_hash('hashes', '0', k)}" for k in range(1, SHINGLE + 1)
    )
    return (
        shingles.select("wanted")
        .distinct()
        .selectExpr("wanted", "size(wanted) AS size", f"{hashes} AS hashes")
        .selectExpr(
            "monotonically_increasing_id() AS sid", "size", f"CASE size {by_size} END AS hash", "wanted"
        )
    )


def found_shingles(docs: DataFrame, shingles: DataFrame, most_broadcast: int) -> DataFrame:
    """``(row, doc_id, digest, n_words, place, sid)`` in one pass over the documents.

    One row per document, with place -1 and no sid, and one per shingle found in it.
    """
    count = shingles.count()
    sizes = sorted(r.size for r in shingles.select("size").distinct().collect())
    tokenised = texts(docs).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64("text").alias("digest"),
        words_of(F.col("text")).alias("words"),
    )
    hashed = tokenised.selectExpr(
        "row", "doc_id", "digest", "CAST(size(words) AS BIGINT) AS n_words", "words",
        "transform(words, w -> xxhash64(w)) AS hashes",
    )
    # The document's own row is a shingle of no words, with a key that no other row has.
    every = ["array(struct(-1 AS place, 0 AS size, row AS hash))"] + [
        f"CASE WHEN size(hashes) < {k} THEN array() ELSE transform(sequence(0, size(hashes) - {k}),"
        f" i -> struct(i AS place, {k} AS size, {shingle_hash('hashes', 'i', k)} AS hash)) END"
        for k in sizes
    ]
    spread = hashed.selectExpr(
        "row", "doc_id", "digest", "n_words", "words", f"inline_outer(concat({', '.join(every)}))"
    )
    words = "slice(words, greatest(place, 0) + 1, spread.size)"
    if count > most_broadcast:  # the words of the place go along, not those of the text
        spread = spread.selectExpr("* EXCEPT (words)", f"{words.replace('spread.', '')} AS here")
        words, known = "here", shingles
    else:
        known = F.broadcast(shingles)
    same = F.expr(f"spread.hash = known.hash AND spread.size = known.size AND {words} = wanted")
    return (
        spread.alias("spread")
        .join(known.alias("known"), same, "left")
        .where("sid IS NOT NULL OR place = -1")
        .select("row", "doc_id", "digest", "n_words", "place", "sid")
    )


def occurrences(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """``(row, window, start, length)``: every place where a whole window stands."""
    counts = found.where("sid IS NOT NULL").groupBy("sid").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "sid", "offset")
    prefix = (
        pieces.join(counts, "sid", "left")
        .groupBy("window", "length")
        .agg(F.min(rarity).alias("rarest"))
        .selectExpr("window", "length", "rarest.sid AS sid", "rarest.offset AS offset")
    )
    candidates = (
        found.join(prefix, "sid")
        .selectExpr("row", "n_words", "window", "length", "place - offset AS start")
        .where("start >= 0 AND start + length <= n_words")
    )
    # Every SHINGLE-th shingle and the last one cover all words of the window.
    cover = pieces.where(f"offset % {SHINGLE} = 0 OR offset = length - {SHINGLE}").selectExpr(
        "window AS of", "offset", "sid", "count(*) OVER (PARTITION BY window) AS needed"
    )
    wanted = candidates.join(cover, F.expr("window = of")).selectExpr(
        "row", "window", "start", "length", "needed", "start + offset AS place", "sid"
    )
    there = found.where("sid IS NOT NULL").select("row", "place", "sid")
    return (
        wanted.join(there, ["row", "place", "sid"])
        .groupBy("row", "window", "start", "length")
        .agg(F.count("*").alias("n"), F.first("needed").alias("needed"))
        .where("n = needed")
        .select("row", "window", "start", "length")
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with the benchmark items found in them.

    Columns: doc_id, digest (xxhash64 of the text), n_words, n_hit (words inside any
    occurrence), n_items, items (array of the item ids as strings, sorted), items_sha256,
    contaminated (a hit, and at least one word of 20). Every row gives one row; rows equal in id
    and text have equal results. Null and empty texts have no words and are clean, very long
    ones are searched whole; an empty table gives no rows and an empty benchmark leaves all
    clean; items without words are ignored, a null item id is written as ''. Windows that
    several items share count for each. Only the named columns are read, so others cannot clash.
    """
    windows = materialize(item_windows(benchmark), "decontaminate-windows")
    parts = window_shingles(windows)
    shingles = materialize(numbered(parts), "decontaminate-shingles")
    pieces = materialize(
        parts.join(shingles.select("sid", "wanted"), "wanted").drop("wanted"), "decontaminate-pieces"
    )
    found = materialize(found_shingles(docs, shingles, most_broadcast), "decontaminate-found")
    hits = materialize(occurrences(found, pieces), "decontaminate-hits")
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0))
    fresh = F.col("start") + F.col("length") - F.greatest(F.col("start"), reach)
    covered = (
        hits.groupBy("row", "start")
        .agg(F.max("length").alias("length"))
        .select("row", F.greatest(fresh, F.lit(0)).alias("fresh"))
        .groupBy("row")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        hits.select("row", "window")
        .distinct()
        .join(windows.select("window", "item"), "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    of_doc = covered.join(named, "row")
    whole = (
        found.where("place = -1")
        .select("row", "doc_id", "digest", "n_words")
        .join(of_doc, "row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )
    return whole.select(
        "doc_id",
        "digest",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes)),
hits AS (
  SELECT doc_id, item_id, grams.size, i FROM grams
  JOIN windows ON grams.g = windows.g AND grams.size = windows.size),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits))
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
