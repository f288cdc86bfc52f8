"""Best-fit decreasing packing of token pieces into sequences of one capacity (operator 11).

Best-fit decreasing takes pieces from the longest to the shortest and
puts each into the open bin with the least room that still holds it, a
new one if there is none.  Pieces of one length are interchangeable, and
so are bins with the same room, so the whole of it is decided by how many
pieces there are of each length: at most ``capacity`` numbers, however
many documents there are.

1. Tasks cut tokenized texts into pieces and number the pieces of each
   length as they come.
2. The counts by length go to the driver, where a segment tree over
   remaining capacities finds the tightest room for a piece in
   logarithmic time.  What comes out are runs: pieces ``first`` to
   ``last`` of one length go into the bins from ``bin`` on, so many to a
   bin, from one offset on.  Their number depends on the capacity alone.
3. Every piece looks its number up in the runs of its length.

No piece is compared with another, and no task sees more than its rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefeed.llm.common import fresh, named, saved, ship, slices, texts

#: Tokens per sequence, and the id that ends every document.
CAPACITY, END_ID = 2048, 0
#: Words remembered per worker, and the longest worth remembering.
CACHE_WORDS, CACHE_CHARS = 300_000, 48
#: Fixed value: a word of Latin-1 letters and the ASCII marks after it, without the apostrophe; the
#: splitter parts the two and cuts neither.
WORD_AND_MARKS = ("^(?P<word>[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)"
                  r"(?P<marks>[!-&(-/:-@\[-`{-~]*)$")
#: New words that are encoded together, and bytes of text whose chunks are looked up together.
WORDS_AT_ONCE, TEXT_BYTES = 200, 4 << 20


# --- tokens ----------------------------------------------------------------------

class _Recent(dict):
    """What was looked up lately: of two generations, the older one goes when the newer one is full."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def missing(self, keys: set) -> set:
        """Those of ``keys`` that are not known; the others are taken over into the newer generation."""
        new = keys.difference(self)
        again = new.intersection(self.older)
        self.update((k, self.older[k]) for k in again)
        return new - again

    def turn(self, most: int, longest: int) -> None:
        """Start a new generation, without long keys, if this one holds half of ``most``."""
        if 2 * len(self) > most:
            self.older = {k: v for k, v in self.items() if len(k) <= longest}
            self.clear()


class _Pool:
    """Token ids of strings, one after the other in one array."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size = flat, size
        self.start = np.cumsum(size) - size

    def take(self, at: np.ndarray) -> _Pool:
        """The strings at these places, in this order."""
        size = self.size[at]
        ends = np.cumsum(size)
        where = np.arange(int(ends[-1]) if len(ends) else 0)
        where += np.repeat(self.start[at] - (ends - size), size)
        return _Pool(self.flat[where], size)


class _Tokens:
    """Token ids of texts, by their chunks.

    The vocabulary's normalizer and splitter never look across a blank and
    drop it, so each distinct chunk between blanks is encoded once.  Most
    chunks are a word and marks after it, and upper case does not matter to
    them; new words are encoded many at a time, and the tokens that end a
    word part them again.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # words in lower case need neither normalizer nor splitter
        self.plain = Tokenizer.from_str(spec)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = json.loads(spec)["model"]["end_of_word_suffix"]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words, self.others = _Recent(), _Recent()

    def _whole(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return ((c, np.array(e.ids, dtype="<u4").tobytes()) for c, e in zip(chunks, found, strict=True))

    def _plain_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            found, = self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            yield from ((w, raw[a:b]) for w, a, b in zip(some, [0, *cuts[:-1]], cuts, strict=True))

    def _pool(self, strings: pa.Array, known: _Recent, find) -> _Pool:
        keys = strings.to_pylist()
        new = known.missing(set(keys))
        if new:
            known.update(find(list(new)))
        packed = list(map(known.__getitem__, keys))
        known.turn(CACHE_WORDS, CACHE_CHARS)
        return _Pool(np.frombuffer(b"".join(packed), dtype="<u4"),
                     np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4)

    def encode(self, texts_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after the other, and where each text's begin (one more than texts)."""
        split = pc.ascii_split_whitespace(texts_)
        chunks = split.flatten().dictionary_encode()
        parts = pc.extract_regex(chunks.dictionary, WORD_AND_MARKS)
        is_word = parts.is_valid().to_numpy(zero_copy_only=False)
        parts = parts.drop_null()
        words = pc.utf8_lower(pc.struct_field(parts, "word")).dictionary_encode()
        marks = pc.struct_field(parts, "marks").dictionary_encode()
        pools = [self._pool(words.dictionary, self.words, self._plain_words),
                 self._pool(marks.dictionary, self.others, self._whole),
                 self._pool(chunks.dictionary.filter(pa.array(~is_word)), self.others, self._whole)]
        first_mark, first_other = len(pools[0].size), len(pools[0].size) + len(pools[1].size)
        pool = _Pool(np.concatenate([p.flat for p in pools]), np.concatenate([p.size for p in pools]))
        # a distinct chunk is two strings of the pool: word and marks, or itself and nothing
        pair = np.full((len(is_word), 2), len(pool.size), dtype=np.int64)
        pair[is_word, 0] = words.indices.to_numpy()
        pair[is_word, 1] = first_mark + marks.indices.to_numpy()
        pair[~is_word, 0] = first_other + np.arange(len(is_word) - is_word.sum())
        pool = _Pool(pool.flat, np.append(pool.size, 0)).take(pair.ravel())
        each = _Pool(pool.flat, pool.size.reshape(-1, 2).sum(axis=1)).take(chunks.indices.to_numpy())
        ends = np.concatenate(([0], np.cumsum(each.size)))
        return each.flat, ends[split.offsets.to_numpy()]


@lru_cache(maxsize=2)
def _tokens(spec: str) -> _Tokens:
    return _Tokens(spec)


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids`` - ids as packed little-endian unsigned 32-bit numbers.

    A document is its text's ids and then ``end_id``; a null or empty text
    is the end id alone.  Only documents of over ``capacity`` ids are cut,
    every ``capacity`` ids.  Rows that repeat, and rows without an id, are
    documents of their own; other columns are not read.  The vocabulary
    must drop blanks before it splits.
    """
    base = texts(docs, id_col, text_col)
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = base.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = _tokens(spec.value), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                doc, number, start, length, ids = [], [], [], [], []
                flat, bounds = tokens.encode(part.column("text"))
                for i, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(),
                                   strict=True):
                    all_ids = flat[a:b].tobytes() + end
                    for n, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                        cut = all_ids[at:at + 4 * capacity]
                        doc.append(i)
                        number.append(n)
                        start.append(at // 4)
                        length.append(len(cut) // 4)
                        ids.append(cut)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return base.mapInArrow(run, PIECES)


# --- the plan, from the counts by length --------------------------------------------

class Rooms:
    """A segment tree over remaining capacities: which ones some open bin has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.leaves)

    def mark(self, room: int, is_open: bool) -> None:
        """Note that bins with this room are open, or that none is any more."""
        at = room + self.leaves
        self.open[at] = is_open
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, least: int) -> int:
        """The smallest room of at least ``least`` that an open bin has; -1 if there is none."""
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:  # up to the first right neighbour with an open bin, then down its left edge
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


class Run(NamedTuple):
    """Pieces of one length from number ``first`` on: ``per_bin`` to a bin, from ``bin`` and ``offset`` on."""

    length: int
    first: int
    bin: int
    per_bin: int
    offset: int


def best_fit_decreasing(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """The runs for ``counts`` pieces of each length, and the number of bins.

    Equal to best-fit decreasing piece by piece: after a piece of length n
    goes to the tightest room r, that bin's room r - n is the tightest
    again as long as it holds n, so a bin takes r // n of them at once,
    and so does every other bin with room r.
    """
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    rooms, bins_of = Rooms(capacity), {}  # room -> ranges (first bin, how many)
    runs: list[Run] = []
    n_bins = 0

    def put(room: int, first: int, how_many: int) -> None:
        if how_many:
            bins_of.setdefault(room, []).append((first, how_many))
            rooms.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room < 0:
                new = -(-left // (capacity // length))
                put(capacity, n_bins, new)
                n_bins += new
                continue
            ranges = bins_of[room]
            first, how_many = ranges.pop()
            if not ranges:
                rooms.mark(room, False)
            per_bin, offset = room // length, capacity - room
            full = min(how_many, left // per_bin)
            if full:
                runs.append(Run(length, number, first, per_bin, offset))
                put(room - per_bin * length, first, full)
                number, left, first, how_many = number + full * per_bin, left - full * per_bin, first + full, how_many - full
            if left and how_many:  # fewer are left than a bin takes
                runs.append(Run(length, number, first, left, offset))
                put(room - left * length, first, 1)
                left, first, how_many = 0, first + 1, how_many - 1
            put(room, first, how_many)
    return runs, n_bins


# --- placing ----------------------------------------------------------------------

def _numbered(rows: DataFrame, length_col: str, capacity: int, block: str, number: str) -> DataFrame:
    """``rows`` with the task that wrote them and their number among the task's rows of one length; saved."""
    schema = T.StructType([*rows.schema.fields, T.StructField(block, T.IntegerType()),
                           T.StructField(number, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False)
            if not len(length):
                continue
            if not (length.dtype.kind == "i" and 1 <= length.min() and length.max() <= capacity):
                raise ValueError(f"lengths must be from 1 to {capacity}")
            order = np.argsort(length, kind="stable")
            first = np.flatnonzero(np.diff(length[order], prepend=0))
            many = np.diff(np.append(first, len(order)))
            of = np.empty(len(order), dtype=np.int64)
            of[order] = np.arange(len(order)) - np.repeat(first, many)
            of += seen[length]
            seen[length[order][first]] += many
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(of), task, np.int32)), pa.array(of)],
                names=[*batch.schema.names, block, number])

    return saved(rows.mapInArrow(run, schema))


def place(rows: DataFrame, capacity: int = CAPACITY, length_col: str = "length",
          sequence_col: str = "sequence_id", offset_col: str = "offset") -> DataFrame:
    """``rows`` with the sequence each goes to and its place there, by best-fit decreasing over all rows.

    Lengths are from 1 to ``capacity`` (others, nulls too, raise).  Rows of
    one sequence lie side by side from 0 on.  Ties (rows of one length) are
    told apart by where they were written; which of them goes where does
    not change the number of sequences.  Columns named like the new ones
    give way to them.  No rows give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    kept = [c for c in rows.columns if c.lower() not in (sequence_col.lower(), offset_col.lower())]
    block, number = fresh("block", kept), fresh("number", kept)
    before = fresh("before", kept)
    numbered = _numbered(rows.select(*map(named, kept)), length_col, capacity, block, number)
    by_block = numbered.groupBy(block, named(length_col).alias(length_col)).agg((F.max(number) + 1).alias("n"))
    counts = {r[0]: r[1] for r in by_block.groupBy(named(length_col)).agg(F.sum("n")).collect()}  # capacity rows at most
    runs, _ = best_fit_decreasing(counts, capacity)
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    # a length has one row a task here, so the window's groups are as long as there are tasks
    earlier = Window.partitionBy(length_col).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_block.select(block, named(length_col).alias(length_col),
                              F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(sequence_col, T.LongType()),
                           T.StructField(offset_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first, bins, per_bin, offset = shared.value.T
        key = (lengths << 44) | first
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            nth = batch.column(number).to_numpy() + batch.column(before).to_numpy()
            at = np.searchsorted(key, (length << 44) | nth, side="right") - 1
            nth = nth - first[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(bins[at] + nth // per_bin[at]),
                 pa.array(offset[at] + nth % per_bin[at] * length)], names=[*kept, sequence_col, offset_col])

    return numbered.join(offsets, [block, length_col]).mapInArrow(run, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """Per sequence: ``sequence_id, length, ids`` and ``members``, its pieces (doc_id, piece, offset, length) in order.

    ``placed`` is what ``place`` makes of ``pieces``.  A sequence is a group
    of ``capacity`` pieces at most.
    """
    member = F.struct("offset", "length", "doc_id", "piece", "ids")
    grouped = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"),
                                                F.array_sort(F.collect_list(member)).alias("m"))
    return grouped.select(
        "sequence_id", "length", F.unhex(F.array_join(F.transform("m", lambda x: F.hex(x["ids"])), "")).alias("ids"),
        F.transform("m", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"),
                                            x["offset"].alias("offset"), x["length"].alias("length"))).alias("members"))


def packed_digest(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = pieces(docs, vocabulary_path)
    return place(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def brute_force(lengths: list[int], capacity: int = CAPACITY) -> int:
    """How many bins best-fit decreasing opens, piece by piece; for tests."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] = fit - n
    return len(rooms)
