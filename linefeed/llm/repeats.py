"""Removal of byte strings that an earlier document also has (operator 9).

A window is a string of ``size`` bytes.  A byte goes if a window over it
also starts in a document with a smaller id.  The windows of all texts
are far too many to sort in one place, so they are split by their
minimiser, the smallest hash among the 24-byte strings inside:

1. ``fingerprints`` counts in how many documents, and how often, each
   minimiser occurs.  A window whose minimiser is in one document only
   repeats nowhere.
2. Runs of windows with one shared minimiser are cut out as short
   strings.  A chunk sends each distinct one once, with the smallest id
   that has it, to the bucket of its minimiser.  Every occurrence of a
   window meets there.  Minimisers of very many documents or occurrences
   send window by window, each to its own bucket, so none fills one task.
3. Where a minimiser's strings are all equal, their smallest id holds for
   each of their windows.  Of the others the bucket builds the suffix array
   by two-stage sorting (``suffixes``).  Neighbours with a common prefix of
   ``size`` bytes are the same window; the smallest id of each group goes
   back to the chunks.
4. The chunks cut the windows out whose smallest id is below their own.
   Where the strings lie, they noted for themselves when they sent them.

Copies of a whole text are settled before by a digest of the text, as
one row per distinct text, and take no part in this.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.llm import fingerprints as fp
from linefeed.llm.common import _BYTE_CODE, _M1, _M2, firsts, mix, parts_for, release, saved, texts
from linefeed.llm.suffixes import Suffixes

#: Length of the strings whose hashes choose the minimiser.
GRAM = 24
#: A minimiser in more documents than this sends its windows one by one; so many of its runs in a chunk count as
#: a document more.
HOT_DOCS, RUNS_A_DOC = 200, 64
#: Bytes of cut-out strings per bucket, aimed at.
BUCKET_BYTES = 4 << 20
#: Windows whose minimisers are found at once, and minimisers that are counted together.
SLAB, GRAMS = 1 << 18, 250_000

_NONE = np.iinfo(np.int64).max

#: Powers of an odd number and of its inverse modulo 2^64, for hashes of stretches by differences of running sums.
_BASE = 0x9E3779B97F4A7C15
_POWERS, _INVERSES = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(SLAB + 2048, b, np.uint64))))
                      for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the strings at these places; starts ascend, no string is longer than 1000 bytes."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        to = int(np.searchsorted(start, base + SLAB))
        part = data[base:int(end[at:to].max())]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[part] * _POWERS[:len(part)], out=sums[1:])
        a, b = start[at:to] - base, end[at:to] - base
        out[at:to] = mix((sums[b] - sums[a]) * _INVERSES[a] ^ (b - a).astype(np.uint64) * _M1)
        at = to
    return out


class _Chunk:
    """The texts of a chunk in one byte array, with their windows and minimisers."""

    def __init__(self, table: pa.Table, copies: set, size: int, cut_up: bool = True):
        ids, texts_ = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        rows = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts_[i]))
        self.ids = [ids[i] for i in rows]
        self.raw = [texts_[i].encode("utf-8") for i in rows]
        self.size = size
        lengths = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.data = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        names = table.column("h").to_pylist()
        self.copy = [(ids[i], names[i]) in copies for i in rows]
        self.taken = np.array([i is not None and not c for i, c in zip(self.ids, self.copy, strict=True)], dtype=bool)
        if cut_up:
            self._windows()

    def _windows(self) -> None:
        """Runs of windows with one minimiser, found slab by slab so that long texts need no more memory."""
        parts = [self._runs(at, min(len(self.data) - self.size + 1, at + SLAB))
                 for at in range(0, len(self.data) - self.size + 1, SLAB)]
        kinds = (np.int64, np.int64, np.uint64, np.int64)
        self.run_start, self.run_end, self.run_key, self.run_doc = (
            np.concatenate([np.empty(0, kind), *(p[i] for p in parts)]) for i, kind in enumerate(kinds))

    def _runs(self, first: int, last: int) -> tuple:
        size = self.size
        count, grams = last - first, size - GRAM + 1
        data = self.data[first:last + size - 1]
        # hashes of 1, 2, 4, 8, 16 and then 24 bytes
        h = _BYTE_CODE[data]
        for width in (1, 2, 4):
            h = h[:-width] * _M1 + h[width:]
        eight = h
        h = (eight[:-8] ^ (eight[:-8] >> np.uint64(29))) * _M2 + eight[8:]
        h = h[:len(data) - GRAM + 1] * _M1 + eight[16:16 + len(data) - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= _M2
        # smallest of the grams inside each window
        low, width = h, 1
        while width * 2 <= grams:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < grams:
            low = np.minimum(low[:count], low[grams - width:grams - width + count])
        low = low[:count]
        # windows that lie in one document, of documents that take part
        valid = np.ones(count, dtype=bool)
        for d in range(int(np.searchsorted(self.ends, first, side="right")), len(self.ends)):
            begin, end = int(self.starts[d]) - first, int(self.ends[d]) - first
            if begin >= count:
                break
            valid[max(0, begin if not self.taken[d] else max(begin, end - size + 1)):max(0, end)] = False
        new = valid.copy()
        new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
        begin = np.flatnonzero(new)
        stop = np.flatnonzero(new | ~valid)
        end = np.append(stop, count)[np.searchsorted(stop, begin, side="right")]
        # a gram that repeats makes longer runs: no run is longer than the windows one gram can lie in
        many = -(-(end - begin) // grams)
        if len(many) and many.max() > 1:
            begin, end = np.repeat(begin, many), np.repeat(end, many)
            begin = begin + grams * (np.arange(len(begin)) - np.repeat(np.cumsum(many) - many, many))
            end = np.minimum(end, begin + grams)
        return begin + first, end + first + size - 1, low[begin], np.searchsorted(self.ends, begin + first, side="right")

    def tally(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimisers, and the weight of each: its documents, and one for so many runs."""
        cut = self.run_key >> np.uint64(64 - fp.KEPT_BITS)
        order = np.lexsort((self.run_doc, cut))
        cut, doc = cut[order], self._ids()[self.run_doc[order]]
        head = np.ones(len(cut), dtype=bool)
        head[1:] = cut[1:] != cut[:-1]
        other = head.copy()
        other[1:] |= doc[1:] != doc[:-1]
        start = np.flatnonzero(head)
        runs = np.diff(np.append(start, len(cut)))
        return cut[start], np.add.reduceat(other.astype(np.int64), start) + runs // RUNS_A_DOC if len(start) else runs

    def _ids(self) -> np.ndarray:
        return np.array([_NONE if i is None else i for i in self.ids], dtype=np.int64)

    def pieces(self, cut: np.ndarray, count: np.ndarray, buckets: int) -> None:
        """The distinct strings to send: their bounds, buckets and smallest ids; ``of`` leads runs to them."""
        docs = count[np.searchsorted(cut, self.run_key >> np.uint64(64 - fp.KEPT_BITS))] if len(cut) else \
            np.empty(0, np.uint8)
        shared = docs >= 2
        start, end = self.run_start[shared], self.run_end[shared]
        key, doc, hot = self.run_key[shared], self.run_doc[shared], docs[shared] > HOT_DOCS
        raw = self.data.tobytes()  # these names are compared within the chunk alone
        name = np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)),
                           np.uint64, len(start))
        if hot.any():  # one string per window there
            many = end[hot] - start[hot] - self.size + 1
            first = np.repeat(start[hot], many)
            first += np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
            single = names(self.data, first, first + self.size)
            start = np.concatenate((start[~hot], first))
            end = np.concatenate((end[~hot], first + self.size))
            doc = np.concatenate((doc[~hot], np.repeat(doc[hot], many)))
            key, name = np.concatenate((key[~hot], single)), np.concatenate((name[~hot], single))
        turn = np.lexsort((doc, name))
        start, end, doc, name, key = start[turn], end[turn], doc[turn], name[turn], key[turn]
        new = np.ones(len(name), dtype=bool)
        new[1:] = name[1:] != name[:-1]
        head = np.flatnonzero(new)
        self.at = start
        key = mix(key[head] + np.uint64(1))
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.of = rank[np.cumsum(new) - 1] if len(name) else np.empty(0, np.int64)
        head = head[order]
        self.bucket, self.piece_start, self.piece_end = bucket[order], start[head], end[head]
        # what is left of the key tells minimisers of one bucket apart
        self.piece_key = ((key[order] // np.uint64(buckets)) & np.uint64((1 << 24) - 1)).astype(np.uint32)
        self.piece_doc = self._ids()[doc[head]]

    def sent(self, chunk: int) -> pa.Table:
        """A row per bucket, and one that comes back to the chunk as it is: where its strings lie."""
        edge = np.flatnonzero(np.concatenate(([True], self.bucket[1:] != self.bucket[:-1], [True]))) \
            if len(self.bucket) else np.zeros(1, np.int64)
        size = self.piece_end - self.piece_start
        rows = {name: [] for name in _STRINGS.names}
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            rows["bucket"].append(int(self.bucket[a]))
            rows["chunk"].append(chunk)
            rows["bytes"].append(_gather(self.data, self.piece_start[a:b], size[a:b]).tobytes())
            rows["sizes"].append(planes(size[a:b], np.uint16))
            rows["ids"].append(planes(self.piece_doc[a:b], np.int64))
            rows["keys"].append(planes(self.piece_key[a:b], np.uint32))
        # occurrences in the order of their strings, so that a count per string tells whose they are
        order = np.argsort(self.of, kind="stable")
        noted = (planes(np.array([len(size), len(order)]), np.int64), planes(size, np.uint16),
                 planes(np.bincount(self.of, minlength=len(size)), np.uint32), planes(self.at[order], np.uint32))
        for name, value in zip(_STRINGS.names, (-1 - chunk, chunk, b"".join(noted), b"", b"", b""), strict=True):
            rows[name].append(value)
        return pa.table(rows, schema=_STRINGS)


_STRINGS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("bytes", pa.binary()), ("sizes", pa.binary()),
                      ("ids", pa.binary()), ("keys", pa.binary())])


def planes(values: np.ndarray, kind: type) -> bytes:
    """Numbers as bytes, all lowest bytes first, so that shuffles compress the higher ones away."""
    raw = np.ascontiguousarray(values, dtype=kind).view(np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, np.dtype(kind).itemsize).T).tobytes()


def joined_planes(data: bytes, kind: type) -> np.ndarray:
    """What ``planes`` took apart."""
    raw = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _noted(data: bytes) -> tuple[np.ndarray, ...]:
    """What a chunk noted for itself: its strings' lengths, how often it has each, and the places of all, string by string."""
    strings, many = joined_planes(data[:16], np.int64).tolist()
    a, b = 16 + 2 * strings, 16 + 6 * strings
    return tuple(joined_planes(x, kind).astype(np.int64) for x, kind in (
        (data[16:a], np.uint16), (data[a:b], np.uint32), (data[b:b + 4 * many], np.uint32)))


def _tidy() -> None:
    """Hand back what Arrow and the arrays of a pass have freed: a worker lives for many passes."""
    pa.default_memory_pool().release_unused()
    release()


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The strings at these places, joined."""
    ends = np.cumsum(size)
    take = np.arange(int(ends[-1]) if len(ends) else 0)
    return data[take + np.repeat(start - (ends - size), size)]


def _smallest(table: pa.Table, size: int) -> pa.Table:
    """The bucket's work: for every window of every string, the smallest id that has it."""
    sizes, ids, key = ([joined_planes(x, kind) for x in table.column(c).to_pylist()]
                       for c, kind in (("sizes", np.uint16), ("ids", np.int64), ("keys", np.uint32)))
    length, ids, key = np.concatenate(sizes).astype(np.int64), np.concatenate(ids), np.concatenate(key)
    joined = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    start = np.cumsum(length) - length
    # the same string may come from many chunks: it counts once, with the smallest id
    name = names(joined, start, start + length)
    order = np.lexsort((name, key))
    name, sorted_key = name[order], key[order]
    new_key = np.ones(len(order), dtype=bool)
    new_key[1:] = sorted_key[1:] != sorted_key[:-1]
    new = new_key.copy()
    new[1:] |= name[1:] != name[:-1]
    head = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], head) if len(head) else np.empty(0, np.int64)
    start, window_of = start[order[head]], length[order[head]] - size + 1
    begin = np.cumsum(window_of) - window_of
    per = np.repeat(least, window_of)
    # a minimiser with one string is settled; the strings of the others are sorted
    of_key = np.cumsum(new_key)[head] - 1
    several = np.flatnonzero(np.bincount(of_key)[of_key] > 1) if len(head) else np.empty(0, np.int64)
    if len(several):
        owner, at, found = _sorted_windows(joined, start[several], window_of[several] + size - 1, least[several], size)
        per[begin[several][owner] + at] = found
    # back to the chunks, string by string as they sent them
    out, ends = [], np.cumsum([0, *map(len, sizes)])
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        p = place[a:b]
        out.append(_gather(per, begin[p], window_of[p]).tobytes())
    _tidy()
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                     "items": pa.array(out, pa.binary())})


def _sorted_windows(joined: np.ndarray, start: np.ndarray, length: np.ndarray, least: np.ndarray,
                    size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some strings: the string, the place in it, and the smallest id of a string that has the window."""
    ends = np.cumsum(length + 1)
    first = ends - length - 1
    text = np.zeros(int(ends[-1]), dtype=np.uint8)  # every string ends with a 0; UTF-8 has no byte 255
    text[np.arange(int(length.sum())) + np.repeat(first - (np.cumsum(length) - length), length)] = _gather(
        joined, start, length) + 1
    owner = np.repeat(np.arange(len(length)), length + 1)
    array = Suffixes(text, size)
    order = array.order[array.left[array.order] >= size]
    common = array.common_prefixes(order, size)
    head = np.flatnonzero(common < size)
    lowest = np.minimum.reduceat(least[owner[order]], head)
    return owner[order], order - first[owner[order]], lowest[np.cumsum(common < size) - 1]


def _split(side: pa.Table) -> tuple[set, pa.Table, pa.Table]:
    """Copies, answers about minimisers and answers about windows, out of a chunk's other side."""
    kind = np.array(side.column("kind").to_pylist(), dtype=np.int64)
    told = side.filter(pa.array(kind == 0))
    copies = set(zip(told.column("doc_id").to_pylist(), told.column("h").to_pylist(), strict=True))
    return copies, side.filter(pa.array(kind == 1)), side.filter(pa.array(kind == 2))


def repeated_spans(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = fp.CHUNK_BYTES) -> DataFrame:
    """Per row: ``doc_id, kept, starts, ends`` - the byte spans to remove, ascending and not touching,
    and the text's remaining bytes, joined.

    ``size`` is at least 32 and less than 1000.  A null id is smaller and larger
    than no other: its row keeps every byte and takes none from others.
    Rows of one id do not take bytes from each other.  Texts shorter
    than ``size``, empty and null ones (read as empty) have no spans.
    """
    if not 32 <= size < 1000:
        raise ValueError("size must be from 32 to 999")
    base = texts(docs, id_col, text_col)
    marks = saved(base.select("doc_id", F.octet_length("text").cast("long").alias("n"),
                              F.xxhash64("text").alias("h"), F.unhex(F.sha2("text", 256)).alias("digest")))
    total = marks.agg(F.sum("n")).first()[0] or 0
    dealt, n_chunks = fp.dealt(base, total, chunk_bytes=chunk_bytes)
    dealt = dealt.withColumn("h", F.xxhash64("text"))
    chunk = F.pmod(F.xxhash64(F.col("doc_id"), F.col("h")), F.lit(n_chunks)).cast("int")
    copies = (firsts(marks.where(F.col("n") >= size)).where("doc_id > first")
              .select(chunk.alias("chunk"), F.lit(-1).alias("bucket"), F.lit(0).alias("kind"), "doc_id", "h",
                      F.lit(None).cast("binary").alias("items")).distinct())
    by_gram = fp.buckets_for(total * 2 / (size - GRAM + 2), GRAMS)
    by_bytes = max(-(-total * 5 // BUCKET_BYTES), 4 * parts_for(docs.sparkSession) if total > BUCKET_BYTES else 1)

    def first_pass(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = fp.sent(key[0].as_py(), *_Chunk(left, _split(right)[0], size).tally(), by_gram)
        _tidy()
        return out

    def second_pass(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        gone, counts, _ = _split(right)
        chunk = _Chunk(left, gone, size)
        cut, _ = chunk.tally()
        chunk.pieces(cut, fp.counts(cut, counts, by_gram), by_bytes)
        out = chunk.sent(key[0].as_py())
        _tidy()
        return out

    def bucket_pass(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:
            return _smallest(table, size)
        # what a chunk noted for itself
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "items": table.column("bytes")})

    def last_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _spans_table([], [], [], [])
        gone, _, windows = _split(right)
        chunk = _Chunk(left, gone, size, cut_up=False)
        answer = dict(zip(windows.column("bucket").to_pylist(), windows.column("items").to_pylist(), strict=True))
        piece_length, often, at = _noted(answer.pop(min(answer)))
        least = np.frombuffer(b"".join(answer[b] for b in sorted(answer)), np.int64)
        per_piece = piece_length - size + 1
        begin = np.cumsum(per_piece) - per_piece
        of = np.repeat(np.arange(len(often)), often)
        many = per_piece[of]
        window = np.repeat(at, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        smallest = _gather(least, begin[of], many)
        doc = np.searchsorted(chunk.ends, at, side="right")
        window = window[smallest < np.repeat(chunk._ids()[doc], many)]
        cover = np.zeros(len(chunk.data) + 1, dtype=np.int32)
        np.add.at(cover, window, 1)
        np.subtract.at(cover, window + size, 1)
        covered = np.cumsum(cover)[:-1] > 0
        starts, ends = [], []
        for i, (a, b) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True)):
            if chunk.copy[i]:
                starts.append([0])
                ends.append([b - a])
                continue
            part = covered[a:b]
            if not part.any():
                starts.append([])
                ends.append([])
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([False], part, [False])).astype(np.int8)))
            starts.append(edge[0::2].tolist())
            ends.append(edge[1::2].tolist())
        kept = [_without(r, a, b) for r, a, b in zip(chunk.raw, starts, ends, strict=True)]
        _tidy()
        return _spans_table(chunk.ids, kept, starts, ends)

    side = copies
    counted = fp.answers(dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(first_pass, fp.SENT))
    side = side.unionAll(_as_side(counted, 1))
    sent = dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        second_pass, "bucket int, chunk int, bytes binary, sizes binary, ids binary, keys binary")
    windows = sent.groupBy("bucket").applyInArrow(bucket_pass, fp.ANSWER)
    side = side.unionAll(_as_side(windows, 2))
    return dealt.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        last_pass, "doc_id long, kept binary, starts array<long>, ends array<long>")


def _as_side(answers: DataFrame, kind: int) -> DataFrame:
    return answers.select("chunk", "bucket", F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                          F.lit(None).cast("long").alias("h"), "items")


def _spans_table(ids: list, kept: list, starts: list, ends: list) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "kept": pa.array(kept, pa.binary()),
                     "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64()))})


def _without(raw: bytes, starts: list[int], ends: list[int]) -> bytes:
    at, parts = 0, []
    for a, b in zip(starts, ends, strict=True):
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def repeats_digest(docs: DataFrame, size: int = 50, chunk_bytes: int = fp.CHUNK_BYTES) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    gone = F.expr("aggregate(zip_with(ends, starts, (e, s) -> e - s), 0L, (a, x) -> a + x)")
    kept = repeated_spans(docs, size, chunk_bytes=chunk_bytes)
    return kept.select("doc_id", (F.octet_length("kept") + gone).cast("long").alias("n_bytes"),
                       gone.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple], size: int = 50) -> list[tuple]:
    """The digest rows of a few documents, window by window; for tests."""
    least: dict[bytes, int] = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - size + 1):
            w = raw[k:k + size]
            if i is not None and i < least.get(w, _NONE):
                least[w] = i
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if i is not None and least[raw[k:k + size]] < i:
                gone[k:k + size] = b"\x01" * size
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
