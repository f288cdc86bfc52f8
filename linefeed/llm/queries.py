"""Registered queries of the text operators: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads its whole table and returns its full result; the
operators keep their own interfaces, and the queries derive their
contract's columns from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefeed.llm import (bpe, chat, decontaminate, filter_audit, licenses, ngram_join, packing, pii,
                          prefix_trie, quality, repeats, templates, toxicity)
from linefeed.llm.common import table

#: The vocabularies of operators 3 and 11; parameters of the operators.
VOCABULARY, PACKED_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """A vocabulary file of the installed package of public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: every document and benchmark item found in it, with the edits between them."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: toxicity score of every document; the lexicon is learned from rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels), toxicity.EXCEPTIONS)
    return toxicity.score(docs, lexicon).select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: every document encoded to tokens and decoded again, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: what is left of every document without lines of recurring templates, as a digest."""
    cleaned = templates.drop_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "dropped_lines",
                          F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("kept_lines"),
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: base counts and verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: every license notice found in a document, with its coverage."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: shingle count and component of every document, five words and 80 percent."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: every conversation rendered from every participant's side, as digests and spans."""
    return chat.rotation_digest(table(spark, sf_dir, "conversations"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: what is left of every document without 50-byte strings that earlier ones have."""
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: personal data in every document, base spans and those the field adds."""
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: every document's pieces of at most 2048 tokens and their places in packed sequences."""
    return packing.packed_digest(table(spark, sf_dir, "documents"), vocabulary_path(PACKED_VOCABULARY))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: per source, order of five filters and step, what the step's filter does."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality": op5_quality,
    "op6_license_scan": op6_license_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_chat": op8_chat,
    "op9_suffix_array": op9_suffix_array,
    "op10_pii": op10_pii,
    "op11_packing": op11_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_filter_audit": op13_filter_audit,
}
