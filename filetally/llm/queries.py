"""Registered queries of the operators: each over its whole table, with its SQL check."""

from __future__ import annotations

from filetally.llm.common import read
from filetally.llm import chat, decontaminate, importance, mixing, ngram_join, prefix_trie
from filetally.llm import quality_rules, suffix_dedup
from filetally.llm.language import identify_languages
from filetally.llm.language_model import score_documents
from filetally.llm.licenses import scan_licenses
from filetally.llm.quality_model import score_quality
from filetally.llm.toxicity import score_toxicity


def op1_ngram_join(spark, tables):
    """Component of every document under the join of three-word shingles at 0.9."""
    rule = ngram_join.Rule(words=3, percent=90)
    return ngram_join.near_duplicates(read(spark, tables, "documents"), rule)


def op2_language_id(spark, tables):
    """Language of every document by words first, then shorter n-grams."""
    return identify_languages(read(spark, tables, "documents"))


def op3_mixing(spark, tables):
    """Training order of the documents with no source seen more than 1.25 times."""
    return mixing.mix_sources(read(spark, tables, "documents"))


def op4_quality_rules(spark, tables):
    """Measures and verdict of line-first cleaning for every document."""
    return quality_rules.assess(read(spark, tables, "documents")).drop("clean_text", "digest")


def op5_chat_format(spark, tables):
    """Rendered conversations that are no snapshot of a longer one."""
    return chat.format_chats(read(spark, tables, "conversations"))


def op6_quality_model(spark, tables):
    """Quality of every document by pooled word vectors and a small network."""
    return score_quality(read(spark, tables, "documents"), read(spark, tables, "labels"))


def op7_license_scan(spark, tables):
    """Matched spans of license templates in every document."""
    return scan_licenses(read(spark, tables, "documents"))


def op8_toxicity(spark, tables):
    """Toxicity of every document by calibrated boosted trees."""
    return score_toxicity(read(spark, tables, "documents"), read(spark, tables, "labels"))


def op9_decontamination(spark, tables):
    """Benchmark items found in every document, and whether they contaminate it."""
    docs, benchmark = read(spark, tables, "documents"), read(spark, tables, "benchmark")
    return decontaminate.find_contamination(docs, benchmark).drop("items", "digest")


def op10_language_model(spark, tables):
    """Log10 probability of every document under the maximum-entropy model."""
    return score_documents(read(spark, tables, "documents"))


def op11_suffix_dedup(spark, tables):
    """Bytes of every document that no earlier one has in a repeat of 50 bytes."""
    return suffix_dedup.digest_columns(suffix_dedup.remove_repeats(read(spark, tables, "documents")))


def op12_prefix_trie(spark, tables):
    """Distinct prefixes of the rebuilt conversations, with what sharing them saves."""
    return prefix_trie.prefix_trie(read(spark, tables, "conversations"))


def op13_importance_resampling(spark, tables):
    """Documents drawn by likeness to the benchmark, with weight, score and rank."""
    docs, target = read(spark, tables, "documents"), read(spark, tables, "benchmark")
    return importance.resample(docs, target).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_language_id,
        op3_mixing,
        op4_quality_rules,
        op5_chat_format,
        op6_quality_model,
        op7_license_scan,
        op8_toxicity,
        op9_decontamination,
        op10_language_model,
        op11_suffix_dedup,
        op12_prefix_trie,
        op13_importance_resampling,
    )
}

SQL_CHECKS: dict[str, str] = {
    "op1_ngram_join": ngram_join.SQL,
    "op3_mixing": mixing.SQL,
    "op4_quality_rules": quality_rules.SQL,
    "op5_chat_format": chat.SQL,
    "op9_decontamination": decontaminate.SQL,
    "op11_suffix_dedup": suffix_dedup.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_importance_resampling": importance.SQL,
}
