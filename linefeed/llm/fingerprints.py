"""Which fingerprints occur in how many documents, without a row per fingerprint.

The texts are dealt into chunks of a few megabytes by a hash of the id
and the text.  Each chunk sends its distinct fingerprints, packed and
sorted, to buckets of the fingerprint space; a bucket adds up the
documents per fingerprint over the chunks and answers every chunk with
one byte per fingerprint it sent.  A fingerprint that a third of all
documents share is therefore one entry per chunk, not one per document.

Chunks are read several times by one query plan.  Spark shuffles the
texts once for them: the plan's exchanges are equal, so it reuses one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.llm.common import texts

#: Bytes of text per chunk, and fingerprints per bucket, aimed at.  A larger
#: corpus with larger executors takes larger values of both.
CHUNK_BYTES, BUCKET_ITEMS = 2 << 20, 1_000_000
#: Fingerprints keep so many bits between chunk and bucket; what two different
#: ones share by chance only looks shared until the texts are compared.
KEPT_BITS = 48
#: Largest document count an answer can tell apart.
MOST = 255


def dealt(docs: DataFrame, total_bytes: int, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """``doc_id, text, chunk``, and how many chunks there are."""
    n = max(1, -(-int(total_bytes) // chunk_bytes))
    return texts(docs, id_col, text_col).withColumn("chunk", chunk_of(n)), n


def chunk_of(n: int, id_col: str = "doc_id", text_col: str = "text"):
    """The chunk of a row: the same wherever it is worked out again."""
    return F.pmod(F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col))), F.lit(n)).cast("int")


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, byte plane by byte plane, so that shuffles compress them."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0)).astype(">u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    """What ``pack`` packed."""
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64), dtype=np.uint64)


def tally(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, cut to ``KEPT_BITS``, and the number of distinct owners of each."""
    cut = values >> np.uint64(64 - KEPT_BITS)
    order = np.lexsort((owner, cut))
    cut, owner = cut[order], owner[order]
    first = np.ones(len(cut), dtype=bool)
    first[1:] = (cut[1:] != cut[:-1]) | (owner[1:] != owner[:-1])
    cut = cut[first]
    start = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1]))) if len(cut) else np.empty(0, np.int64)
    return cut[start], np.diff(np.concatenate((start, [len(cut)])))


SENT = "bucket int, chunk int, items binary, docs binary"
ANSWER = "chunk int, bucket int, items binary"


def sent(chunk: int, cut: np.ndarray, docs: np.ndarray, buckets: int) -> pa.Table:
    """Rows of ``SENT``: the tally split into buckets, which are ranges of the fingerprints."""
    bucket = _bucket(cut, buckets)
    edge = np.searchsorted(bucket, np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(edge))
    return pa.table({
        "bucket": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * len(used), pa.int32()),
        "items": pa.array([pack(cut[edge[b]:edge[b + 1]]) for b in used], pa.binary()),
        "docs": pa.array([np.minimum(docs[edge[b]:edge[b + 1]], 65535).astype(np.uint16).tobytes() for b in used],
                         pa.binary())})


def _bucket(cut: np.ndarray, buckets: int) -> np.ndarray:
    return (cut // np.uint64(-(-(1 << KEPT_BITS) // buckets))).astype(np.int64)


def answers(rows: DataFrame) -> DataFrame:
    """``ANSWER`` for rows of ``SENT``: the documents per fingerprint over all chunks, at most ``MOST``."""
    def add(table: pa.Table) -> pa.Table:
        items = [unpack(x) for x in table.column("items").to_pylist()]
        docs = [np.frombuffer(x, np.uint16).astype(np.int64) for x in table.column("docs").to_pylist()]
        distinct, place = np.unique(np.concatenate(items), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(docs), minlength=len(distinct))
        count = np.minimum(total, MOST).astype(np.uint8)[place]
        ends = np.cumsum([0, *map(len, items)])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "items": pa.array([count[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)],
                                           pa.binary())})

    return rows.groupBy("bucket").applyInArrow(add, ANSWER)


def counts(cut: np.ndarray, answer: pa.Table, buckets: int) -> np.ndarray:
    """The answer's byte per fingerprint of ``tally``, in its order."""
    out = np.zeros(len(cut), dtype=np.uint8)
    edge = np.searchsorted(_bucket(cut, buckets), np.arange(buckets + 1))
    for b, data in zip(answer.column("bucket").to_pylist(), answer.column("items").to_pylist(), strict=True):
        out[edge[b]:edge[b + 1]] = np.frombuffer(data, np.uint8)
    return out


def buckets_for(items: float, per_bucket: int = BUCKET_ITEMS) -> int:
    return max(1, int(-(-items // per_bucket)))


Rows = Iterator[pa.RecordBatch]

