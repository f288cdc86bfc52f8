from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: A few documents with what can go wrong: nulls, no words, long words, repeated rows and ties.
LONG = "long " * 3000 + "x" * 5000
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 74),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 74),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 74),
    (3, None, "en", "a", 0), (4, "", None, "a", 0), (5, " \n\t ", "en", None, None), (6, LONG, "en", "b", len(LONG)),
    (None, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a", 74),
    (7, "élan \U0001f600 naïve\x00   text <|endoftext|> 1 2 3", "fr", "b", 40), (8, "one", "en", "b", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = ("ids", "score", "dropped_lines", "kept", "chunk", "n", "h", "row", "component_id", "node", "label")


@pytest.fixture(scope="session")
def edge(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
