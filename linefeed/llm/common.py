"""Helpers shared by the text operators: inputs, hashing, connected components.

Conventions of every operator here: a null text counts as the empty
text, a null id is an id like any other (it is returned as null), rows
that repeat are handled one by one, and columns an operator does not
name are never read, so their names cannot clash with its own.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefeed.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, whole."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


#: Spark's limit on an Arrow batch, its default, and what takes its place where it is not set.
BATCH_CONF, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, through Spark's own file server."""
    # a task holds a batch in the JVM, in Arrow and as Python strings: smaller ones than Spark's default
    if spark.conf.get(BATCH_CONF, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_linefeed_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="linefeed-ship-"), "linefeed.zip")
    with zipfile.ZipFile(name, "w") as out:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(name)
    context._linefeed_shipped = True


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text becomes the empty text."""
    ship(docs.sparkSession)
    return docs.select(named(id_col).cast("long").alias("doc_id"),
                       F.coalesce(named(text_col), F.lit("")).alias("text"))


def named(column: str):
    """A column by its name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(name: str, columns: list[str]) -> str:
    """The name, or one like it that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parts_for(spark: SparkSession, at_least: int = 1) -> int:
    """Partitions for a key shuffle: the session's setting, or more if asked for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), at_least)


def slices(batch: pa.RecordBatch, text_col: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text together, at least one row each."""
    sizes = np.array([len(t) if t else 0 for t in batch.column(text_col).to_pylist()], dtype=np.int64)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if len(sizes) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


#: Parts that a text with very many copies is dealt into when its copies are marked.
SALT = 16


def firsts(marks: DataFrame) -> DataFrame:
    """``marks`` (``doc_id``, ``digest``, more) with ``first``: the smallest id with the same text.

    Only texts on several rows meet their first id by a join; they are
    salted, and both sides are plain shuffles, so a text with a third of
    all rows is spread over tasks.  ``first`` of other rows, and of rows
    without an id, is their own id.
    """
    several = (marks.where("doc_id is not null").groupBy("digest")
               .agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
               .select("digest", "least", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    salted = marks.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
    return (salted.join(several, ["digest", "salt"], "left")
            .withColumn("first", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")))
            .drop("salt", "least"))


def release() -> None:
    """Hand the memory a chunk's arrays have freed back to the system; workers live for many chunks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# --- hashing of words, inside tasks -------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORD_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): spreads every input bit over the result."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_BASE))


class _Codes(dict):
    """64-bit hashes of words (bytes), remembered; bounded, and emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        code = xxhash.xxh64_intdigest(word)
        if len(word) <= 40:
            self[word] = code
        return code


_CODES = _Codes()


def codes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, in order."""
    return np.fromiter(map(_CODES.__getitem__, words), dtype=np.uint64, count=len(words))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, the runs free of ASCII white space, in order; A-Z lower-cased."""
    return codes(text.encode("utf-8", "surrogatepass").lower().split())


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    k = min(size, len(words))
    h = np.full(len(words) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        h = mix(h * _M1 + words[i:len(words) - k + 1 + i])
    return np.unique(h)


# --- connected components -------------------------------------------------------

def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)``: the smallest node that links reach, for every node of an edge.

    ``edges`` has two long columns ``a`` and ``b``.  Alternates large-star
    and small-star steps, which need about log(n) rounds; each is a
    ``min`` per node (combined map-side, so a hub is one partial row a
    task) and a join AQE can split.  Every round is checkpointed.
    """
    spark = edges.sparkSession
    pairs = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct())
    for _ in range(most_rounds):
        both = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour is tied to the smallest node around
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: the smaller neighbours are tied to the smallest of them
        tied = large.join(low, "u")
        small = (tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        now = saved(small)
        # stable once the edges no longer change: every node hangs on one root
        changed = (now.exceptAll(pairs).limit(1).count() or pairs.exceptAll(now).limit(1).count())
        pairs = now
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
