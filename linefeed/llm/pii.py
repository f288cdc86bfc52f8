"""Personal data: patterns, and a semi-Markov conditional random field (operator 10).

The base patterns find e-mail addresses, IP addresses, card and phone
numbers.  The field then looks at whole stretches of words with a digit
or an at sign, spelled ``(at)`` or ``[at]`` too.  It scores every segment
of at most ``MOST_WORDS`` words as a whole (shape, length, checksums, the
word before) for every kind, and one dynamic program chooses boundaries
and kinds together.  A segment it names that touches no base span is
added; base spans stay.

Words stream through the program: scores are kept for the last
``MOST_WORDS`` words, and what was chosen is given out wherever no segment
of a positive score goes on.  A long text of numbers is thus never held
as a lattice.

The field's weights are trained here, on at most ``TRAIN_REGIONS``
stretches of a sample of the documents, by the gradient of the
conditional likelihood.  Its labels are the base spans that fill their
segment, quoted or assigned hexadecimal keys of 32 or more digits, and
what the base cannot name: to every labelled stretch that has one, the
same address, number or key written another way is added (``respelled``).
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.llm.common import ship, slices, texts

#: Kinds in the order in which spans with one start are listed; the base finds the first four.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Words of a segment at most.
MOST_WORDS = 6
#: Documents sampled for training, about, and stretches trained on at most.
TRAIN_DOCS, TRAIN_REGIONS, EPOCHS = 3000, 500, 6
#: Words of a stretch, and code points of it, that are trained on at most; finding has no such bound.
TRAIN_WORDS, TRAIN_CHARS = 64, 2000

# The patterns of the contract.  A match can only begin where a run of its first
# characters begins, and greedy runs never give back; saying so keeps them linear.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL_HERE = re.compile(_EMAIL)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Addresses, leftmost first; only the stretches around at signs are looked at."""
    out: list[tuple[int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        # the run of local characters before this sign, not before the end of the last match
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _EMAIL_HERE.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)
    return out


_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


_HOT = re.compile(r"[0-9@]|[(\[]at[)\]]")
_OPEN, _SHUT = "\"'[{<=:;,", "\"']}>,;:!?.%#*&$|"
_SPACES = frozenset(" \t\n\r\x0b\x0c")


def hot_words(text: str) -> Iterator[tuple[int, int, bool]]:
    """Bounds of the words with a digit or an at sign, and whether each goes on a stretch: one blank after the last."""
    n, done = len(text), -2
    m = _HOT.search(text)
    while m:
        a = m.start()
        while a > max(done, 0) and text[a - 1] not in _SPACES:
            a -= 1
        b = m.end()
        while b < n and text[b] not in _SPACES:
            b += 1
        yield a, b, a - done == 1 and text[a - 1] == " "
        done = b
        m = _HOT.search(text, b)


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Stretches of neighbouring words with a digit or an at sign: the words' bounds."""
    out: list[list[tuple[int, int]]] = []
    for a, b, goes_on in hot_words(text):
        if goes_on:
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A segment without the punctuation around it."""
    while start < end and text[start] in _OPEN:
        start += 1
    while end > start and text[end - 1] in _SHUT:
        end -= 1
    return start, end


_HEX = re.compile(r"[0-9a-fA-F]+")
_KEYWORD = re.compile(r"(?i)(?:token|key|secret|password|passwd|pwd|apikey)\W*$")


_DIGITS, _LETTERS = re.compile("[0-9]+"), re.compile("[A-Za-z]+")
_PLAIN, _FOUR = re.compile(r"[0-9 -]+"), re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_SPELLED_AT = re.compile(r"[(\[]at[)\]]")


def context(text: str, start: int) -> list[str]:
    """What stands before a segment; the same for all segments that begin at one word."""
    while start < len(text) and text[start] in _OPEN:
        start += 1
    before = text[max(0, start - 24):start]
    return (["keyword"] if _KEYWORD.search(before) else []) + (["assigned"] if before[-1:] in ("=", ":", '"', "'") else [])


def features(text: str, start: int, end: int, before: list[str] | None = None) -> list[str]:
    """What a whole segment looks like, and its context; the same for every kind."""
    a, b = trimmed(text, start, end)
    span = text[a:b]
    digits = _NO_DIGIT.sub("", span)
    shape = _LETTERS.sub("a", _DIGITS.sub("9", span)) if len(span) <= 64 else "long"
    out = ["bias", f"digits={min(len(digits), 24)}", f"words={span.count(' ') + 1}",
           "shape=" + (shape if len(shape) <= 14 else "long")]
    if "@" in span:
        out.append(f"at={span.count('@')} dots={min(3, span.rpartition('@')[2].count('.'))}")
    elif "at" in span and _SPELLED_AT.search(span):
        out.append(f"spelled at, dots={min(3, _SPELLED_AT.split(span)[-1].count('.'))}")
    if digits:
        if span[0] == "+":
            out.append("plus")
        if span[0] in "+(0" and 9 <= len(digits) <= 15 and "." not in span:
            out.append("as a number to dial")
        if _PLAIN.fullmatch(span):
            out.append(f"plain digits, checked={len(digits) in range(12, 20) and luhn(digits)}")
        elif 12 <= len(digits) <= 19 and not _LETTERS.search(span):
            out.append(f"digits and marks, checked={luhn(digits)}")
        if _FOUR.fullmatch(span):
            out.append("four" if all(len(p) < 4 and int(p) < 256 for p in span.split(".")) else "four, too large")
    if len(span) >= 16:
        bare = span.replace("-", "").replace(" ", "")
        if len(bare) >= 16 and _HEX.fullmatch(bare):
            out.append(("hex" if len(bare) >= 32 else "short hex") + (" in parts" if len(bare) < len(span) else ""))
    return out + (context(text, start) if before is None else before)


class Field:
    """Weights per kind and feature; kind -1 (no entity) takes one word and scores 0."""

    def __init__(self, weights: dict[tuple[int, str], float] | None = None):
        self.weights = dict(weights or {})
        self._known: dict[tuple[str, ...], list[float]] = {}

    def _lattice(self, text: str, words: list[tuple[int, int]]):
        """Per last word and length: the segment's features and its scores by kind."""
        cells = {}
        for j in range(len(words)):
            for size in range(1, min(MOST_WORDS, j + 1) + 1):
                f = features(text, words[j - size + 1][0], words[j][1])
                cells[j, size] = f, self._scores(f)
        return cells

    def best(self, text: str, words: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """``(first word's start, last word's end, kind)`` of the entities of the best segmentation of a stretch.

        Only the last words are held, and the choices since the last word
        at which no segment of a positive score was open: up to there the
        best segmentation is settled, as words outside score 0.
        """
        held: list[tuple[int, int, list[str]]] = []  # words since the choices before were settled, and their contexts
        best, back = [0.0], [None]
        open_to = 0  # a segment of a positive score reaches this far into the held words
        for word in words:
            held.append((*word, context(text, word[0])))
            j = len(held) - 1
            top, how = best[j], None
            for size in range(1, min(MOST_WORDS, j + 1) + 1):
                first = held[j - size + 1]
                scores = self._remembered(features(text, first[0], word[1], first[2]))
                for kind, score in enumerate(scores):
                    if best[j + 1 - size] + score > top:
                        top, how = best[j + 1 - size] + score, (size, kind)
                if max(scores) > 0:
                    open_to = j + 1
            best.append(top)
            back.append(how)
            # no segment that matters can begin before the last words and go on after them
            if len(held) - open_to >= MOST_WORDS:
                yield from self._chosen(held, back)
                keep = held[1 - MOST_WORDS:]
                held, best, back, open_to = keep, [0.0] * (len(keep) + 1), [None] * (len(keep) + 1), 0
        yield from self._chosen(held, back)

    def _scores(self, found: list[str]) -> list[float]:
        return [sum(self.weights.get((k, x), 0.0) for x in found) for k in range(len(KINDS))]

    def _remembered(self, found: list[str]) -> list[float]:
        """``_scores`` of features seen before, as most are; bounded, and emptied when full."""
        key = tuple(found)
        scores = self._known.get(key)
        if scores is None:
            if len(self._known) >= 50_000:
                self._known.clear()
            scores = self._known[key] = self._scores(found)
        return scores

    @staticmethod
    def _chosen(words: list[tuple], back: list) -> list[tuple[int, int, int]]:
        out, j = [], len(words)
        while j:
            if back[j] is None:
                j -= 1
            else:
                size, kind = back[j]
                out.append((words[j - size][0], words[j - 1][1], kind))
                j -= size
        return out[::-1]

    def train(self, data: list[tuple[str, list, list]], epochs: int = EPOCHS, rate: float = 0.5,
              decay: float = 1e-3) -> None:
        """Stochastic gradient of the log-likelihood; data: text, words, gold ``(first, last, kind)``."""
        for epoch in range(epochs):
            step = rate / (1 + epoch)
            for text, words, gold in data:
                cells = self._lattice(text, words)
                n = len(words)
                fore, aft = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
                for j in range(n):
                    terms = [fore[j]] + [fore[j + 1 - s] + x for s in range(1, min(MOST_WORDS, j + 1) + 1)
                                         for x in cells[j, s][1]]
                    fore[j + 1] = _logsum(terms)
                for i in range(n - 1, -1, -1):
                    terms = [aft[i + 1]] + [aft[i + s] + x for s in range(1, min(MOST_WORDS, n - i) + 1)
                                            for x in cells[i + s - 1, s][1]]
                    aft[i] = _logsum(terms)
                named = {(b, b - a + 1, k) for a, b, k in gold}
                for (j, s), (f, scores) in cells.items():
                    for k, x in enumerate(scores):
                        p = math.exp(min(0.0, fore[j + 1 - s] + x + aft[j + 1] - fore[n]))
                        g = ((j, s, k) in named) - p
                        if abs(g) > 1e-4:
                            for name in f:
                                w = self.weights.get((k, name), 0.0)
                                self.weights[k, name] = w + step * (g - decay * w)


def _logsum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms)) if top > -math.inf else top


def gold(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Labels of a stretch, from the base spans and from assigned hexadecimal keys."""
    out = []
    taken = 0
    known = {(a, b): k for a, k, b in base_spans(text)}
    for i in range(len(words)):
        if i < taken:
            continue
        for j in range(min(len(words), i + MOST_WORDS) - 1, i - 1, -1):
            span = trimmed(text, words[i][0], words[j][1])
            kind = known.get(span)
            if kind is None and i == j and span[1] - span[0] >= 32 and _HEX.fullmatch(text, *span) \
                    and text[:span[0]].rstrip("\"' ").endswith(("=", ":")):
                kind = 4
            if kind is not None:
                out.append((i, j, kind))
                taken = j + 1
                break
    return out


def respelled(text: str, words: list[tuple[int, int]], labels: list[tuple[int, int, int]],
              rng: random.Random) -> tuple[str, list, list] | None:
    """The stretch with one labelled span written as the base patterns do not know it, and its label there."""
    for first, last, kind in labels:
        a, b = trimmed(text, words[first][0], words[last][1])
        span = text[a:b]
        digits = _NO_DIGIT.sub("", span)
        if kind == 0:
            new = span.replace("@", rng.choice((" (at) ", "(at)", "[at]")).strip(), 1)
        elif kind == 2:
            step = rng.choice((4, 4, 3))
            new = rng.choice((".", "/", " . ")).strip().join(digits[i:i + step] for i in range(0, len(digits), step))
        elif kind == 3:
            new = rng.choice(("0{} {}", "(0{}) {}", "00{} {}", "0{}/{}")).format(digits[:3], digits[3:])
        elif kind == 4:
            step = rng.choice((8, 16))
            new = "-".join(span[i:i + step] for i in range(0, len(span), step))
        else:
            continue
        changed = text[:a] + new + text[b:]
        for words_ in regions(changed):
            for i in range(len(words_)):
                for j in range(i, min(len(words_), i + MOST_WORDS)):
                    if trimmed(changed, words_[i][0], words_[j][1]) == (a, a + len(new)):
                        rest = [g for g in gold(changed, words_) if g[1] < i or g[0] > j]
                        return changed, words_, sorted([*rest, (i, j, kind)])
    return None


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field trained on a bounded sample; untrained, finding nothing, where no stretch has a label.

    About ``TRAIN_DOCS`` documents are looked at, the first ``TRAIN_WORDS``
    words of each of their stretches, and of these ``TRAIN_REGIONS`` of at
    most ``TRAIN_CHARS`` code points.  Null and empty texts have none.
    """
    ship(docs.sparkSession)
    every = max(1, docs.count() // TRAIN_DOCS)
    sample = texts(docs, id_col, text_col).where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(every)) == 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                start = end = size = 0
                for a, b, goes_on in chain(hot_words(text), [(0, 0, False)]):
                    if goes_on:
                        size += 1
                        end = b if size <= TRAIN_WORDS else end
                        continue
                    if size:
                        found.append(text[max(0, start - 40):end + 8])
                    start, end, size = a, b, 1
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["text"])

    held = (sample.select("text").mapInArrow(cut, "text string").where(F.length("text") < TRAIN_CHARS).distinct()
            .orderBy(F.xxhash64("text"), "text").limit(TRAIN_REGIONS).collect())
    data, rng = [], random.Random(5)
    for row in held:
        for words in regions(row["text"]):
            labels = gold(row["text"], words)
            data.append((row["text"], words, labels))
            more = respelled(row["text"], words, labels, rng)
            if more:
                data.append(more)
    field = Field()
    if any(g for _, _, g in data):
        field.train(data)
    field.weights = {k: round(w, 5) for k, w in field.weights.items() if abs(w) > 1e-3}
    return field


class _Stretch:
    """The words of one stretch, as they come; ``next`` is then the first word of the next one."""

    def __init__(self, first: tuple[int, int, bool], rest: Iterator[tuple[int, int, bool]]):
        self.first, self.rest, self.next = first, rest, None

    def __iter__(self) -> Iterator[tuple[int, int]]:
        yield self.first[:2]
        for word in self.rest:
            if not word[2]:
                self.next = word
                return
            yield word[:2]


def spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans, as sorted ``(start, kind, end)``."""
    base = base_spans(text)
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))
    added = []
    words = hot_words(text)
    word = next(words, None) if field.weights else None
    while word:
        stretch = _Stretch(word, words)
        for start, end, kind in field.best(text, stretch):
            a, b = trimmed(text, start, end)
            before = bisect_left(starts, b)  # base spans that begin before the segment ends
            if a < b and not (before and reach[before - 1] > a):
                added.append((a, kind, b))
        word = stretch.next
    return base, sorted(base + added)


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``base`` and ``spans`` - arrays of kind, start, end (code points, end excluded).

    Null and empty texts have none; repeated rows repeat theirs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field.weights)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                both = [spans(t, own) for t in part.column("text").to_pylist()]
                cols = [pa.array([[(KINDS[k], a, b) for a, k, b in x[c]] for x in both], pa.list_(kind))
                        for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], names=["doc_id", "base", "spans"])

    item = "array<struct<kind: string, start: long, end: long>>"
    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id long, base {item}, spans {item}")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, SHA-256 of the base spans, and all spans as text.

    Null and empty texts have counts of 0, the digest of nothing and no
    spans; spans of one start stand in the order of ``KINDS``; repeated rows
    repeat theirs, and columns but id and text are not read.
    """
    def joined(column: str):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return find(docs, learned(docs)).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:4]), F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))
