"""Quality rules: line-first cleaning, then rejection of documents that lose too much text.

Every line with a word is judged by three rules: punctuation (a long line without a sentence
mark, or a line of symbols), navigation (separators between short entries) and boilerplate
(site phrases). Failing lines are removed; a document is rejected if the words that remain
hold too small a part of its characters, or if it fails the base rules (too short, or too
many words in repeated three-word windows).

All of it are SQL expressions on one row, so nothing is shuffled. Repeated windows are found
by sorting window hashes within the row, which takes n log n steps for a text of n words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]"
SPACES = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
# Phrases of site furniture, in the corpus languages.
PHRASES = [
    "cookie",
    "javascript",
    "all rights reserved",
    "privacy policy",
    "terms of use",
    "terms of service",
    "click here",
    "read more",
    "sign in",
    "sign up",
    "log in",
    "subscribe",
    "newsletter",
    "lorem ipsum",
    "alle rechte vorbehalten",
    "impressum",
    "tous droits réservés",
    "mentions légales",
    "todos los derechos reservados",
    "aviso legal",
]
BOILERPLATE = f"(?i)({'|'.join(PHRASES)})"


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeated: int = 50  # per cent of words in repeated windows
    long_line: int = 12  # words; from here on a line needs a sentence mark
    separators: int = 2  # at least so many make a navigation line
    most_symbols: int = 10  # per cent of a line's characters
    most_lost: int = 50  # per cent of the word characters


def chars_without(text: Column, pattern: str) -> Column:
    """Code points left after removing what matches."""
    return F.length(F.regexp_replace(text, pattern, ""))


def words_of(text: Column) -> Column:
    """Words of a text. Splitting costs a fraction of extracting, which copies the text's rest."""
    return F.array_remove(F.split(text, SPACES), "")


def may_have_phrase(text: Column) -> Column:
    """False for most texts, whose lines need not be searched for phrases."""
    low, found = F.lower(text), F.lit(False)
    for phrase in PHRASES:
        found = found | low.contains(phrase)
    return found


def line_fails(line: Column, rules: Rules) -> Column:
    """The line breaks the punctuation or the navigation rule."""
    symbols = chars_without(line, NOT_SYMBOL)
    punctuation = (
        (F.size(words_of(line)) >= rules.long_line) & ~line.rlike(r"[.!?…;:。！？]")
    ) | (100 * symbols > rules.most_symbols * chars_without(line, SPACES))
    separators = F.length(line) - chars_without(line, r"[|»›•·]")
    return punctuation | (separators >= rules.separators)


def clean_lines(rules: Rules) -> Column:
    """The lines that break no rule; phrases are looked for only in texts that have some."""
    return F.when(
        F.col("phrases"),
        F.filter("lines", lambda x: ~line_fails(x, rules) & ~x.rlike(BOILERPLATE)),
    ).otherwise(F.filter("lines", lambda x: ~line_fails(x, rules)))


def assess(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) with their measures, verdict and cleaned text.

    Columns: doc_id, digest (xxhash64 of the text), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_failed_lines, clean_chars, clean_text. Rows are judged one by one, so repeated rows
    and repeated ids give one row each. A null text counts as an empty one: no words, base
    failed, not kept, empty cleaned text. Two different windows of one text are taken for equal
    if their 64-bit hashes are; for 20,000 words that has a probability below 1e-10. Write the
    result before filtering on it: Spark pushes a filter below the measures and would then
    evaluate them again for every use.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.xxhash64("text").alias("digest"), text.alias("text")).select(
        "doc_id",
        "digest",
        "text",
        words_of(F.col("text")).alias("words"),
        may_have_phrase(F.col("text")).alias("phrases"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    hashed = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).select(
        "doc_id",
        "digest",
        F.size("words").cast("long").alias("n_words"),
        chars_without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        chars_without(F.col("text"), NOT_SYMBOL).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        clean_lines(rules).alias("clean"),
        F.expr(
            "CASE WHEN size(words) < 3 THEN array() ELSE transform(sequence(0, size(words) - 3),"
            " i -> xxhash64(hashes[i], hashes[i + 1], hashes[i + 2])) END"
        ).alias("windows"),
    )
    # Most texts repeat no window; only the others pay for the sort.
    ordered = hashed.withColumn(
        "ordered",
        F.expr(
            "CASE WHEN size(array_distinct(windows)) < size(windows)"
            " THEN array_sort(transform(windows, (h, i) -> struct(h, i))) END"
        ),
    ).drop("windows")
    placed = ordered.withColumn(
        "places",
        F.expr(
            "transform(filter(ordered, (w, k) -> (k > 0 AND get(ordered, k - 1).h = w.h)"
            " OR coalesce(get(ordered, k + 1).h = w.h, false)), w -> w.i)"
        ),
    ).drop("ordered")
    repeated = F.expr(
        "coalesce(size(array_distinct(flatten(transform(places, i -> array(i, i + 1, i + 2))))), 0)"
    ).cast("long")
    measured = placed.withColumn("n_repeat_words", F.when(F.isnull("places"), 0).otherwise(repeated))
    measured = measured.withColumn("n_repeat_words", F.col("n_repeat_words").cast("long"))
    failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words")
    )
    cleaned = measured.select(
        "doc_id",
        "digest",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (F.col("n_lines") - F.size("clean")).cast("long").alias("n_failed_lines"),
        F.array_join("clean", "\n").alias("clean_text"),
    ).withColumn("clean_chars", chars_without(F.col("clean_text"), SPACES).cast("long"))
    enough = 100 * (F.col("word_chars") - F.col("clean_chars")) <= (
        rules.most_lost * F.col("word_chars")
    )
    return cleaned.withColumn("kept", ~F.col("base_failed") & enough)


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1)
  GROUP BY doc_id),
split AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM texts),
lines AS (SELECT * FROM split WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT doc_id, l,
    (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 12
       AND NOT regexp_matches(l, '[.!?…;:。！？]'))
    OR 100 * length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g'))
       > 10 * length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))
    OR length(regexp_replace(l, '[^|»›•·]+', '', 'g')) >= 2
    OR regexp_matches(l, '{boilerplate}') AS bad
  FROM lines),
by_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS dup, count_if(bad) AS bad,
    sum(CASE WHEN bad THEN 0 ELSE length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) END) AS clean
  FROM judged GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    coalesce(bad, 0) AS n_failed_lines, coalesce(clean, 0) AS clean_chars
  FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * (word_chars - clean_chars) <= 50 * word_chars AS kept,
  CAST(n_failed_lines AS BIGINT) AS n_failed_lines, CAST(clean_chars AS BIGINT) AS clean_chars
FROM measured
""".replace("{boilerplate}", BOILERPLATE)
