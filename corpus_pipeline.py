"""Pipeline from raw documents to tokens: five stages, each over what the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all
but the last return the columns of ``docs``.  ``run`` writes each stage's
result as Parquet in the shared folder and reads it again for the next,
so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefeed.llm import bpe, decontaminate, ngram_join, templates, toxicity
from linefeed.llm.common import fresh, named, table
from linefeed.llm.queries import vocabulary_path
from linefeed.session import staging_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that score as toxic go; the lexicon is learned from the labelled ones among them."""
    lexicon = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")), toxicity.EXCEPTIONS)
    return toxicity.without_toxic(docs, lexicon)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines of recurring templates go, and documents that had nothing else.

    ``n_chars`` is counted anew where a line went.
    """
    dropped = fresh("dropped_lines", docs.columns)
    cleaned = templates.drop_lines(docs, count_col=dropped)
    emptied = (F.col(dropped) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cleaned = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned.select(*map(named, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near duplicates stays, the one with the smallest id."""
    return ngram_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the token ids of every text, and digests of them and of the text decoded from them."""
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path(), decoded_col="text")
    return ids.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_filter), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("bpe", tokens)]

#: No SQL expresses these stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
