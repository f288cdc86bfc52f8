"""Line dedup by a tree of log templates (operator 4).

A line is a sequence of words.  Words with a digit are variable fields
from the start.  A tree of fixed depth sorts lines by their number of
words and their first ``DEPTH`` words into leaves; in a leaf, lines that
agree in at least ``SIMILAR`` of their words share a template, and the
words they differ in become variable fields too.  A template found in at
least ``LEAST_DOCS`` different texts (``LONG_DOCS`` if it is long) is
boilerplate: its lines go, except in the document with the smallest id
(and its copies), which keeps them.

The texts are dealt into chunks once (see ``fingerprints``).  First the
chunks learn how many texts each leaf has; only lines of leaves with
enough of them are sent on, each distinct line once per chunk with a few
of its ids.  A leaf stays whole, however many texts it has; its lines
find their templates through an index, not by trying each.  What comes
back is a list of lines to drop.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.llm import fingerprints as fp
from linefeed.llm.common import firsts, named, saved, ship

#: Leading words of a leaf.
DEPTH = 3
#: Part of the words in which a line must agree with a template.
SIMILAR = 0.7
#: Different texts a template must be in, and words a line must have, to be boilerplate.
LEAST_DOCS, LEAST_WORDS = 5, 3
#: The same for templates of so many words, which do not recur by chance.
LONG_DOCS, LONG_WORDS = 2, 15
#: What stands for a variable field.
FIELD = b"<*>"

_DIGIT = re.compile(rb"[0-9]").search


def masked(words: list[bytes]) -> list[bytes]:
    """The words, those with a digit as variable fields."""
    if not _DIGIT(b"".join(words)):
        return words
    return [FIELD if _DIGIT(w) else w for w in words]


def leaf(words: list[bytes]) -> int:
    """The leaf of a line, as a 64-bit hash: its length and leading words."""
    return xxhash.xxh64_intdigest(b"%d " % len(words) + b" ".join(masked(words[:DEPTH])))


def grown(lines: list[tuple[bytes, list[int]]], similar: float = SIMILAR) -> list[int]:
    """The template of each line of one leaf.  Lines of many documents come first, then by their words.

    A line may differ from its template in ``differ`` words at most.  Of
    ``differ + 1`` blocks of words one is then equal in both, so only
    templates that share a block with the line are compared with it.
    """
    order = sorted(range(len(lines)), key=lambda i: (-len(lines[i][1]), lines[i][0]))
    names: dict[bytes, int] = {FIELD: 0}
    rows = np.array([[names.setdefault(w, len(names)) for w in lines[i][0].split(b" ")] for i in order], np.int32)
    need = int(np.ceil(similar * rows.shape[1]))
    blocks = np.array_split(np.flatnonzero((rows != rows[0]).any(0)), max(0, rows.shape[1] - need) + 1)
    index: list[dict[bytes, list[int]]] = [{} for _ in blocks]
    templates = np.empty_like(rows)
    count, out = 0, [0] * len(lines)
    for place, i in enumerate(order):
        row, best = rows[place], -1
        parts = [row[b].tobytes() for b in blocks]
        near = np.array(sorted(set().union(*(x.get(p, ()) for x, p in zip(index, parts, strict=True)))), np.int64)
        if len(near):
            fits = (templates[near] == row).sum(1)
            if fits.max() >= need:
                near = near[fits == fits.max()]
                best = int(near[(templates[near] == 0).sum(1).argmin()])
        if best < 0:
            best, count = count, count + 1
            templates[best] = row
            changed = range(len(blocks))
        else:
            wide = templates[best] != row
            templates[best][wide] = 0
            changed = [k for k, b in enumerate(blocks) if wide[b].any()] if wide.any() else []
        for k in changed:
            held = index[k].setdefault(templates[best][blocks[k]].tobytes(), [])
            if best not in held[-1:]:
                held.append(best)
        out[i] = best
    return out


def texts_for(words: int, least_docs: int, long_docs: int, long_words: int) -> int:
    """Different texts that a template of so many words must be in."""
    return min(least_docs, long_docs) if words >= long_words else least_docs


class _Chunk:
    """A chunk's rows and their lines, as bytes; words are the runs free of ASCII white space."""

    def __init__(self, table: pa.Table, side: pa.Table, least_words: int):
        self.ids = table.column("doc_id").to_pylist()
        self.texts = table.column("text").cast(pa.binary()).to_pylist()
        copy = np.array([k == 0 for k in side.column("kind").to_pylist()], dtype=bool)
        told = side.filter(pa.array(copy))
        first = {(i, h): f for i, h, f in zip(*(told.column(c).to_pylist() for c in ("doc_id", "h", "first")),
                                              strict=True)}
        #: The smallest id with the same text, and whether that is the row's own (or the id is null).
        self.holder = [first.get((i, h), i) for i, h in zip(self.ids, table.column("h").to_pylist(), strict=True)]
        self.counts = [i is not None and i == f for i, f in zip(self.ids, self.holder, strict=True)]
        self.rest = side.filter(pa.array(~copy))
        #: Lines of each row, and the leaf of each line that is long enough for a template.
        self.lines = [(t or b"").split(b"\n") for t in self.texts]
        self.leaves = [[leaf(w) if len(w) >= least_words else None for w in map(bytes.split, lines)]
                       for lines in self.lines]

    def tally(self) -> tuple[np.ndarray, np.ndarray]:
        """All leaves, and in how many texts each is; copies and rows without an id count for none."""
        leaves = [{x for x in own if x is not None} for own in self.leaves]
        every = np.unique(np.array([x for own in leaves for x in own], np.uint64) >> np.uint64(64 - fp.KEPT_BITS))
        owner = [(x, k) for k, own in enumerate(leaves) if self.counts[k] for x in own]
        cut, n = fp.tally(np.array([x for x, _ in owner], np.uint64), np.array([k for _, k in owner], np.int64))
        docs = np.zeros(len(every), np.int64)
        docs[np.searchsorted(every, cut)] = n
        return every, docs

    def recurring(self, answer: pa.Table, buckets: int, least_docs: int, long_docs: int, long_words: int):
        """Row, line number, leaf and masked words of each line whose leaf has enough texts."""
        cut, _ = self.tally()
        count = fp.counts(cut, answer, buckets)
        few = count >= min(least_docs, long_docs)
        known = dict(zip(cut[few].tolist(), count[few].tolist(), strict=True))
        shift = 64 - fp.KEPT_BITS
        for k, leaves in enumerate(self.leaves):
            for n, x in enumerate(leaves):
                if x is not None and x >> shift in known:
                    words = self.lines[k][n].split()
                    if known[x >> shift] >= texts_for(len(words), least_docs, long_docs, long_words):
                        yield k, n, x, b" ".join(masked(words))


def drop_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_words: int = LEAST_WORDS,
               similar: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text",
               count_col: str = "dropped_lines", chunk_bytes: int = fp.CHUNK_BYTES, long_docs: int = LONG_DOCS,
               long_words: int = LONG_WORDS) -> DataFrame:
    """``docs``, every column and row, with ``text_col`` cleaned and a column ``count_col`` added.

    A null text stays null.  A row with a null id keeps its lines and
    counts for no template.  Copies of a text count once.  Rows of one
    id and different texts count once too.  ``least_docs`` is at most
    255; for templates of ``long_words`` words ``long_docs`` takes its
    place where that is less.  A column that is named like ``count_col`` gives way to it.
    """
    if not 2 <= least_docs <= fp.MOST or long_docs < 2:
        raise ValueError("least_docs is from 2 to 255, long_docs 2 at least")
    docs = docs.select(*(named(c) for c in docs.columns if c.lower() != count_col.lower()))
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce(named(text_col), F.lit(""))
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select((F.struct(*map(named, others)) if others else F.struct(F.lit(0).alias("none"))).alias("row"),
                       named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"))
    marks = saved(docs.select(named(id_col).cast("long").alias("doc_id"), F.octet_length(key).cast("long").alias("n"),
                              F.xxhash64(key).alias("h"), F.unhex(F.sha2(key, 256)).alias("digest")))
    total = marks.agg(F.sum("n")).first()[0] or 0
    n_chunks = max(1, -(-int(total) // chunk_bytes))
    buckets = fp.buckets_for(total / 20)
    n_bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // (32 << 20)))
    chunk = F.pmod(F.xxhash64(F.col("doc_id"), F.col("h")), F.lit(n_chunks)).cast("int")
    dealt = rows.withColumn("h", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).withColumn("chunk", chunk)
    empty = F.lit(None).cast("binary")
    side = (firsts(marks).where("doc_id > first").select(
        chunk.alias("chunk"), F.lit(-1).alias("bucket"), F.lit(0).alias("kind"), "doc_id", "h", "first",
        empty.alias("items")).distinct())

    def first_pass(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return fp.sent(key[0].as_py(), *_Chunk(left, right, least_words).tally(), buckets)

    def second_pass(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = _Chunk(left, right, least_words)
        held: dict[tuple[int, bytes], set[int]] = {}
        for k, _, leaf_, line in own.recurring(own.rest, buckets, least_docs, long_docs, long_words):
            ids = held.setdefault((leaf_, line), set())
            if own.counts[k]:
                ids.add(own.ids[k])
        # the smallest few ids of a line say all: whether there are enough, and which is first
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(held), pa.int32()),
            "leaf": pa.array(np.array([leaf_ for leaf_, _ in held], np.uint64).view(np.int64)),
            "line": pa.array([line for _, line in held], pa.binary()),
            "ids": pa.array([sorted(v)[:least_docs] for v in held.values()], pa.list_(pa.int64()))})

    def cluster(table: pa.Table) -> pa.Table:
        leaves: dict[int, dict[bytes, tuple[list[int], list[int]]]] = {}
        for leaf_, line, ids, at in zip(*(table.column(c).to_pylist() for c in ("leaf", "line", "ids", "chunks")),
                                        strict=True):
            leaves.setdefault(leaf_, {})[line] = (ids, at)
        chunks, names, shallow, keepers = [], [], [], []
        for held in leaves.values():
            lines = [(line, ids) for line, (ids, _) in held.items()]
            need = texts_for(lines[0][0].count(b" ") + 1, least_docs, long_docs, long_words)
            if len({i for _, ids in lines for i in ids}) < need:
                continue
            of = grown(lines, similar)
            docs_of: dict[int, set[int]] = {}
            for (_, ids), t in zip(lines, of, strict=True):
                docs_of.setdefault(t, set()).update(ids)
            for (line, _), t in zip(lines, of, strict=True):
                if len(docs_of[t]) >= need:
                    for at in held[line][1]:
                        chunks.append(at)
                        names.append(xxhash.xxh64_intdigest(line))
                        shallow.append(leaf(line.split(b" ")))
                        keepers.append(min(docs_of[t]))
        # one row for each chunk: the lines to drop, and who keeps them
        order = sorted(range(len(chunks)), key=chunks.__getitem__)
        rows: dict[int, list[int]] = {}
        for i in order:
            rows.setdefault(chunks[i], []).append(i)
        number = table.column("bin")[0].as_py()
        return pa.table({
            "chunk": pa.array(list(rows), pa.int32()), "bucket": pa.array([number] * len(rows), pa.int32()),
            "items": pa.array([np.array([names[i] for i in r], np.uint64).tobytes()
                               + np.array([shallow[i] for i in r], np.uint64).tobytes()
                               + np.array([keepers[i] for i in r], np.int64).tobytes() for r in rows.values()],
                              pa.binary())})

    out_type = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType()),
                             T.StructField("dropped_lines", T.LongType())])

    def last_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        own = _Chunk(left, right, least_words)
        kind = np.array(own.rest.column("kind").to_pylist(), dtype=np.int64)
        drop: dict[int, int] = {}
        touched: set[int] = set()
        for data in own.rest.filter(pa.array(kind == 2)).column("items").to_pylist():
            names, shallow, keepers = np.frombuffer(data, np.uint64).reshape(3, -1)
            drop.update(zip(names.tolist(), keepers.view(np.int64).tolist(), strict=True))
            touched.update(shallow.tolist())
        texts, dropped = [], []
        for i, holder, text, lines, leaves in zip(own.ids, own.holder, own.texts, own.lines, own.leaves, strict=True):
            keep = [x not in touched or i is None
                    or drop.get(xxhash.xxh64_intdigest(b" ".join(masked(line.split()))), holder) == holder
                    for x, line in zip(leaves, lines, strict=True)]
            dropped.append(len(keep) - sum(keep))
            texts.append(text if all(keep) else b"\n".join(x for x, k in zip(lines, keep, strict=True) if k))
        return pa.table({"row": left.column("row"), "text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "dropped_lines": pa.array(dropped, pa.int64())})

    counted = fp.answers(dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(first_pass, fp.SENT))
    side = side.unionAll(_as_side(counted, 1))
    lines = dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        second_pass, "chunk int, leaf long, line binary, ids array<long>")
    # a line of many chunks is one row before its leaf meets in a task
    lines = lines.groupBy("leaf", "line").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, least_docs).alias("ids"),
        F.collect_list("chunk").alias("chunks")).withColumn("bin", F.pmod("leaf", F.lit(n_bins)).cast("int"))
    told = lines.groupBy("bin").applyInArrow(cluster, fp.ANSWER)
    side = side.where("kind = 0").unionAll(_as_side(told, 2))
    done = dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(last_pass, out_type)
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                         for c in docs.columns), F.col("dropped_lines").alias(count_col))


def _as_side(answers: DataFrame, kind: int) -> DataFrame:
    none = F.lit(None).cast("long")
    return answers.select("chunk", "bucket", F.lit(kind).alias("kind"), none.alias("doc_id"), none.alias("h"),
                          none.alias("first"), "items")


def brute_force(rows: list[tuple], least_docs: int = LEAST_DOCS, least_words: int = LEAST_WORDS,
                similar: float = SIMILAR, long_docs: int = LONG_DOCS, long_words: int = LONG_WORDS) -> list[tuple]:
    """``(id, text, dropped)`` of a few documents with distinct ids, on one machine; for tests."""
    first: dict[str, int] = {}
    for i, text in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)

    def name(line: str) -> bytes:
        return b" ".join(masked(line.encode().split()))

    held: dict[int, dict[bytes, set[int]]] = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            words = line.encode().split()
            if i is not None and len(words) >= least_words:
                held.setdefault(leaf(words), {}).setdefault(name(line), set()).add(first[text or ""])
    keeper: dict[bytes, int] = {}
    for lines in held.values():
        known = [(line, sorted(ids)[:least_docs]) for line, ids in lines.items()]
        docs_of: dict[int, set[int]] = {}
        of = grown(known, similar)
        for (line, _), t in zip(known, of, strict=True):
            docs_of.setdefault(t, set()).update(lines[line])
        for (line, _), t in zip(known, of, strict=True):
            if len(docs_of[t]) >= texts_for(line.count(b" ") + 1, least_docs, long_docs, long_words):
                keeper[line] = min(docs_of[t])
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        keep = [p for p in parts if i is None or keeper.get(name(p), first[text or ""]) == first[text or ""]]
        out.append((i, text if len(keep) == len(parts) else "\n".join(keep), len(parts) - len(keep)))
    return out
