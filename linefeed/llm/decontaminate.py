"""Benchmark decontamination by embedding and bit sampling (operator 1).

An item is a sequence of words (lower case, letters and digits only); in
scripts that set no blanks between words every character is one.
The CGK embedding walks over the words of a window with random bits: at
every step it writes the current word and moves on or stays, as a random
function of step and word says.  Two windows at a small edit distance
are walked in step again soon after an edit, so their embeddings differ
in few places (Hamming distance).  Bit sampling then hashes a few random
places of the embedding; windows with equal samples are candidates.

Each repeat has its own walk, its own places and, for every item, its
own starting word, so an edit spoils some repeats only; the number of
repeats follows from the recall wanted and the item's length.  A repeat's
first sampled place is the window's first word, so on the document side
only windows that begin with the starting word of some item have to be
walked at all, and most of them end at the second place.

Windows are as long as what is left of the item after its starting word,
rounded down to one of ``SIZES``: items and documents are walked to the
same end, and places are drawn within it.

Candidates are verified exactly: the least number of word edits that
turn the item into some stretch of the document around the window must
be at most ``edits`` of its words.

Items of fewer than five words may have no edit at 20 percent, so they are
found as they are; an item of a single common word is found wherever that
word is, which ``least_words`` can rule out.

The items are broadcast in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` of text; every block is a pass over the documents, and the
tables of a block are built once per worker.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefeed.llm.common import _M1, _WORD_BASE, codes, mix, named, saved, ship, slices

#: Part of an item's words that may be edited, and the recall wanted at that distance.
EDITS, RECALL = 0.2, 0.99
#: Sampled places per repeat, after the first word.
PLACES = 2
#: Words of a window that are walked at most: places are sampled from these.
WALKED = 24
#: Window lengths in words, and item lengths that get repeats of their own.
SIZES = np.array([1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, WALKED])
LENGTHS = np.array([1, 5, 6, 7, 8, 9, 10, 12, 15, 20, 25, 30, 40, 60])
#: Simulated items, and walks of each, behind the number of repeats; the most repeats of any item.
TRIALS, WALKS, MOST_REPEATS = 400, 150, 400
#: Part of the items allowed to be missed that simulated ones may miss: one in so many.
MARGIN = 8
#: Items, and bytes of their texts, that are searched for in one pass over the documents.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20

_FOLD = bytes(c if 0x30 <= c < 0x3A or 0x61 <= c < 0x7B or c >= 0x80 else c + 32 if 0x41 <= c < 0x5B else 0x20
              for c in range(256))


#: Fixed value: characters of scripts that are written without blanks (Thai to Myanmar, Khmer, kana, ideographs),
#: each a word, and marks of these scripts and general punctuation, which part words.
_UNSPACED = re.compile("([\u0E01-\u0E3A\u0E40-\u0E4E\u0E80-\u0EFF\u1000-\u109F\u1780-\u17D3\u3005-\u3007\u3040-\u30FA"
                       "\u30FC-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF])")
_MARKS = re.compile("[\u00A0-\u00A9\u00AB-\u00B1\u00B4\u00B6-\u00B8\u00BB\u00BF\u2000-\u206F\u3000-\u3004\u3008-\u303F\u30FB"
                    "\uFF00-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65]")


def words_of(text: str) -> list[bytes]:
    """The words of a text: lower case, parted by anything that is no letter or digit; unspaced characters are words."""
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", _MARKS.sub(" ", text.lower()))
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def word_codes(text: str) -> np.ndarray:
    """64-bit hashes of the words."""
    return codes(words_of(text))


@lru_cache(maxsize=1000)
def repeats_for(recall: float, edits: float, length: int) -> int:
    """Repeats that reach the recall for items of so many words when that part of the words is edited.

    Items of distinct words are edited at random and walked; what share
    of an item's repeats agrees with its edited copy depends on where the
    edits are, so the share found is averaged over the items.  Real items
    repeat words and share one draw of places, which ``MARGIN`` is for.
    """
    rng = np.random.default_rng(length)
    part = range(max(1, 2 * length // 3))
    item = np.arange(length)
    hits = np.zeros(TRIALS)
    for _ in range(3):
        old, new, at, here, sizes, trial = [], [], [], [], [], []
        begin = 0
        for t in range(TRIALS):
            own = mix(rng.integers(1, 1 << 62, length, dtype=np.uint64))
            words, place = own.tolist(), item.tolist()
            for p in rng.integers(0, length, int(edits * length)).tolist():
                p = min(p, len(words) - 1)
                kind, other = rng.integers(3), int(rng.integers(1, 1 << 62))
                words[p:p + 1] = [[], [other], [words[p], other]][kind] if len(words) > 1 else [other]
                place[p:p + 1] = [[], [-1], [place[p], -1]][kind] if len(place) > 1 else [-1]
            fit = rng.permutation(part)[:len(part) // 3 + 1]
            for start in rng.choice(fit, WALKS // 3).tolist():
                at.append(t * length + start)
                here.append(begin + place.index(start) if start in place else -1)
                sizes.append(length - start)
                trial.append(t)
            old.append(own)
            after = mix(rng.integers(1, 1 << 62, WALKED, dtype=np.uint64))
            new.append(np.concatenate([np.array(words, np.uint64), after]))
            begin += len(new[-1])
        old, new = np.concatenate(old), np.concatenate(new)
        at, here, trial, size = np.array(at), np.array(here), np.array(trial), SIZES[size_class(np.array(sizes))]
        for w in range(WALKS // 3):
            # one walk and one draw of places for the w-th window of every item
            pick = np.arange(w, len(at), WALKS // 3)
            pick = pick[here[pick] >= 0]
            for n in np.unique(size[pick]).tolist():
                same = pick[size[pick] == n]
                places, walk = drawn(rng, n), int(rng.integers(1 << 20))
                _, left, _ = samples(old, at[same], at[same] + n, places, walk)
                _, right, _ = samples(new, here[same], here[same] + n, places, walk)
                np.add.at(hits, trial[same], left == right)
    miss = 1 - hits / (WALKS // 3 * 3)
    need = np.arange(1, MOST_REPEATS + 1)
    found = 1 - (miss[None, :] ** need[:, None]).mean(1)
    return int(need[min(np.searchsorted(found, 1 - (1 - recall) / MARGIN), MOST_REPEATS - 1)])


def size_class(words: np.ndarray) -> np.ndarray:
    """Which of ``SIZES`` windows of so many words at most have."""
    return np.maximum(0, np.searchsorted(SIZES, words, side="right") - 1)


def drawn(rng: np.random.Generator, size: int) -> np.ndarray:
    """Places of a repeat: steps of the walk in which it is likely to be within so many words."""
    return np.sort(rng.choice(np.arange(1, max(2 * size, PLACES + 1)), PLACES, replace=False))


class Items:
    """A block of items, given by ids and texts, and the hash tables of all repeats."""

    def __init__(self, ids: list, texts: list[str], edits: float = EDITS, recall: float = RECALL, seed: int = 7,
                 repeats: dict[int, int] | None = None):
        self.ids, self.texts, self.edits, self.recall = ids, texts, edits, recall
        spelled = [words_of(t) for t in texts]
        self.words = [codes(w) for w in spelled]
        lengths = LENGTHS[np.searchsorted(LENGTHS, [len(w) for w in spelled], side="right") - 1]
        #: Repeats of each length of items; worked out once, on the driver.
        self.repeats = repeats or {n: repeats_for(recall, edits, n) for n in np.unique(lengths).tolist()}
        wanted = np.array([self.repeats[n] if w else 0 for n, w in zip(lengths.tolist(), spelled, strict=True)], np.int64)
        rng = np.random.default_rng(seed)
        joined = np.concatenate([*self.words, np.zeros(0, np.uint64)])
        begin = np.cumsum([0, *map(len, self.words)])
        #: Per repeat and window length: the repeat, the length, places, hashes up to the first place, and items by hash.
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray, dict[int, list[tuple[int, int]]]]] = []
        first: list[np.ndarray] = []
        for r in range(int(wanted.max(initial=0))):
            places = [drawn(rng, n) for n in SIZES.tolist()]
            use = np.flatnonzero(wanted > r)
            offset = np.array([_start(spelled[i], r) for i in use.tolist()], np.int64)
            at = begin[use] + offset
            size = size_class(begin[use + 1] - at)
            for c in np.unique(size).tolist():
                same, n = np.flatnonzero(size == c), int(SIZES[c])
                kept, keys, early = samples(joined, at[same], at[same] + n, places[c], r)
                table: dict[int, list[tuple[int, int]]] = {}
                for k, key in zip(same[kept].tolist(), keys.tolist(), strict=True):
                    table.setdefault(key, []).append((int(use[k]), int(offset[k])))
                self.tables.append((r, n, places[c], np.unique(early), table))
                first.append(np.unique(joined[at[same]]))
        self.starts = np.unique(np.concatenate([*first, np.empty(0, np.uint64)]))
        #: Starting words of each table.
        self.begins = [np.searchsorted(self.starts, f) for f in first]
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.starts >> np.uint64(44)).astype(np.int64)] = True

    def find(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """For each text, the items found: fewest edits, and the words spanned (first such span)."""
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        own = [word_codes(t) if t else np.empty(0, np.uint64) for t in texts]
        words = np.concatenate([*own, np.zeros(0, np.uint64)])
        ends = np.cumsum([len(w) for w in own])
        maybe = np.flatnonzero(self.filter[(words >> np.uint64(44)).astype(np.int64)])
        if not len(maybe) or not len(self.starts):
            return best
        which = np.minimum(np.searchsorted(self.starts, words[maybe]), len(self.starts) - 1)
        real = self.starts[which] == words[maybe]
        maybe, which = maybe[real], which[real]
        order = np.argsort(which, kind="stable")
        maybe = maybe[order]
        begin = np.searchsorted(which[order], np.arange(len(self.starts) + 1))
        text_of = np.searchsorted(ends, maybe, side="right")
        seen: set[tuple[int, int]] = set()
        for (r, n, places, known, table), starts in zip(self.tables, self.begins, strict=True):
            use = np.concatenate([np.arange(begin[s], begin[s + 1]) for s in starts.tolist()])
            at, text = maybe[use], text_of[use]
            kept, keys, _ = samples(words, at, np.minimum(at + n, ends[text]), places, r, known)
            for k, key in zip(kept.tolist(), keys.tolist(), strict=True):
                for item, offset in table.get(key, ()):
                    p, t = int(at[k]) - offset, int(text[k])
                    if (item, p) in seen:
                        continue
                    seen.add((item, p))
                    found = self._verify(own[t], item, p - int(ends[t]) + len(own[t]))
                    if found and (item not in best[t] or found < best[t][item]):
                        best[t][item] = found
        return best

    def _verify(self, words: np.ndarray, item: int, at: int) -> tuple[int, int, int] | None:
        own = self.words[item]
        most = int(self.edits * len(own))
        low, high = max(0, at - most), min(len(words), at + len(own) + most)
        edits, end = fewest_edits(own.tolist(), words[low:high].tolist())
        if edits > most:
            return None
        back, size = fewest_edits(own.tolist()[::-1], words[low:low + end].tolist()[::-1])
        return edits, low + end - size, low + end


def _start(words: list[bytes], repeat: int) -> int:
    """Where in the item a repeat's window begins: a longer word of its first two thirds, which few texts share."""
    part = range(max(1, 2 * len(words) // 3))
    size = sorted((len(words[i]) for i in part), reverse=True)[len(part) // 3]
    fit = [i for i in part if len(words[i]) >= size]
    return fit[xxhash.xxh32_intdigest(words[0], seed=repeat) % len(fit)] if words else 0


def samples(words: np.ndarray, at: np.ndarray, end: np.ndarray, places: np.ndarray, repeat: int,
            known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows are left, the hashes of their sampled places, and the hashes up to the first place.

    A walk that has left its window writes a fixed mark.  With ``known``,
    windows whose hash up to the first place is not in it are left there.
    """
    kept = np.arange(len(at))
    here, key, early = at.copy(), words[at], np.empty(0, np.uint64)
    for step in range(int(places[-1]) + 1):
        if not len(here):
            break
        word = np.where(here < end, words[np.minimum(here, len(words) - 1)], np.uint64(1))
        if step == places[0]:
            early = key = mix(key * _M1 + word)
            if known is not None:
                near = np.isin(key, known)
                kept, here, key, end, word = kept[near], here[near], key[near], end[near], word[near]
        elif step in places:
            key = mix(key * _M1 + word)
        bit = mix(word ^ np.uint64((repeat * 1009 + step + 1) * _WORD_BASE & (1 << 64) - 1)) >> np.uint64(63)
        here = here + bit.astype(np.int64)
    return kept, key, early


def fewest_edits(item: list, text: list) -> tuple[int, int]:
    """Edit distance of the item to the best stretch of the text, and where that stretch ends.

    Bit-parallel: one machine word per item of any length, one step per word of the text.
    """
    m = len(item)
    if not m:
        return 0, 0
    where: dict = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best, best_end = m, 0
    for j, w in enumerate(text):
        eq = where.get(w, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(diag | up) & full, diag & up
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = right << 1 & full, left << 1 & full
        up, down = left | ~(diag | right) & full, diag & right
        if score < best:
            best, best_end = score, j + 1
    return best, best_end


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", edits: float = EDITS,
                recall: float = RECALL, block_items: int = BLOCK_ITEMS, least_words: int = 1,
                block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of bounded size; items of fewer than ``least_words`` words are not searched for."""
    rows = items.select(named(id_col).cast("long").alias("i"), named(text_col).alias("t")).where(
        F.col("i").isNotNull() & F.col("t").isNotNull())
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    blocks = max(1, -(-count // block_items), -(-size // block_bytes))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b) if blocks > 1 else rows
        held = [(i, t) for i, t in sorted((r["i"], r["t"]) for r in part.distinct().collect())
                if len(words_of(t)) >= least_words]
        yield Items([i for i, _ in held], [t for _, t in held], edits, recall)


_BLOCKS: dict[str, Items] = {}


def _block(shared) -> Items:
    """The tables of a broadcast block, built once per worker; a worker holds those of two blocks at most."""
    name, ids, texts, edits, recall, repeats = shared.value
    if name not in _BLOCKS:
        if len(_BLOCKS) > 1:
            _BLOCKS.clear()
        _BLOCKS[name] = Items(ids, texts, edits, recall, repeats=repeats)
    return _BLOCKS[name]


def _send(spark: SparkSession, block: Items):
    return spark.sparkContext.broadcast(
        (uuid.uuid4().hex, block.ids, block.texts, block.edits, block.recall, block.repeats))


def leaks(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL, id_col: str = "doc_id",
          text_col: str = "text", block_items: int = BLOCK_ITEMS, least_words: int = 1) -> DataFrame:
    """Per row and item found in it: ``doc_id, item_id, edits, first_word, end_word``.

    ``edits`` is the fewest word edits, the words are counted from 0, the
    end not included.  Null or empty texts have no leaks, null items, items
    without a text and those of fewer than ``least_words`` words (none by
    default) are not searched for; of items with one id and several texts
    each is.  Repeated rows give repeated results.
    """
    ship(docs.sparkSession)
    out = None
    for block in item_blocks(items, edits=edits, recall=recall, block_items=block_items, least_words=least_words):
        shared = _send(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = _block(shared)
            for batch in batches:
                rows = []
                for part in slices(batch, "text"):
                    found = own.find(part.column("text").to_pylist())
                    rows.extend((i, own.ids[k], *v) for i, f in
                                zip(part.column("doc_id").to_pylist(), found, strict=True)
                                for k, v in sorted(f.items()))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_LEAK.names, r, strict=True)) for r in rows], schema=_LEAK)

        found = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text")).mapInArrow(
            run, "doc_id long, item_id long, edits int, first_word int, end_word int")
        out = found if out is None else out.unionAll(found)
    return out


_LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                   ("first_word", pa.int32()), ("end_word", pa.int32())])


def without_leaks(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL,
                  text_col: str = "text", block_items: int = BLOCK_ITEMS, least_words: int = 1) -> DataFrame:
    """``docs``, all columns, without the rows that hold an item.  Rows with a null text stay.

    Between two blocks of items the rows left are saved, so that a task
    holds the tables of one block.
    """
    ship(docs.sparkSession)
    first = True
    for block in item_blocks(items, edits=edits, recall=recall, block_items=block_items, least_words=least_words):
        docs = docs if first else saved(docs)
        first, shared = False, _send(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = _block(shared)
            for batch in batches:
                for part in slices(batch, text_col):
                    yield part.filter(pa.array([not f for f in own.find(part.column(text_col).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def brute_force(rows: list[tuple], items: list[tuple], edits: float = EDITS) -> set[tuple]:
    """``(doc_id, item_id, edits)`` of a few documents, every item against every text; for tests."""
    out = set()
    for i, text in rows:
        words = word_codes(text or "").tolist()
        for item, t in items:
            own = word_codes(t or "").tolist()
            n = fewest_edits(own, words)[0]
            if own and n <= int(edits * len(own)):
                out.add((i, item, n))
    return out
