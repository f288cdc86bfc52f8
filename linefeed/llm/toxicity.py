"""Toxicity by a weighted lexicon (operator 2).

A text is folded first: upper case, homoglyphs of other scripts, and
digits or signs that stand for letters ("1d10t", "$tup1d") become plain
letters, so that one lexicon entry finds every spelling.  A text with
accents is read twice, with them and without; the heavier reading
counts.  An Aho-Corasick automaton finds all lexicon entries and all exception
phrases in one pass; an entry inside an exception phrase does not count.
Each entry has a weight; the weights found are summed, normalised by the
length of the text and turned into a probability.

The lexicon is learned from labelled rows by Spark: how many toxic and
how many other documents hold each folded word, as a whole or by its
first letters.  It keeps at most ``MOST_ENTRIES`` entries, whatever the
size of the corpus, and is therefore safe to broadcast.  Exception
phrases are learned as well: two words, one of them with an entry, that
stand together in several other documents and in no toxic one, more often
than the word's own share among toxic documents lets chance do.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.llm.common import ship, texts

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u",
    "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

#: At most so many lexicon entries, learned from at most so many labelled rows
#: (those with the smallest hashes of their ids), and at most so many learned exceptions.
MOST_ENTRIES, MOST_EXCEPTIONS, LEARN_ROWS = 4000, 1000, 40_000
#: A word or beginning becomes an entry if this many toxic training documents hold it, its
#: weight, a log-likelihood ratio, is at least this, and chance would not find it so
#: unevenly spread: its evidence in nats exceeds the log of the number of candidates by this.
LEAST_DOCS, LEAST_WEIGHT, EVIDENCE = 3, 1.5, 2.0
#: Lengths of the word beginnings that may become entries.
PREFIXES = (4, 5, 6, 7, 8)


@lru_cache(maxsize=1)
def _styled() -> dict[int, str]:
    """Code points from letterlike signs on that stand for ASCII letters or digits: mathematical, circled and others."""
    out = {}
    for c in range(0x2100, 0x20000):  # the planes after these have ideographs and private characters alone
        if unicodedata.decomposition(chr(c)):
            plain = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))
            if plain.isascii() and plain.isalnum():
                out[c] = plain.lower()
    return out


@lru_cache(maxsize=2)
def _fold_table(accents: bool) -> dict[int, str]:
    """Code point to letters: lower case, homoglyphs replaced, accents kept if so asked."""
    out = {}
    for c in range(0x80, 0x2100):
        low = chr(c).lower()
        plain = "".join(x for x in unicodedata.normalize("NFKD", low) if not unicodedata.combining(x))
        plain = "".join(HOMOGLYPHS.get(x, x) for x in plain)
        keep = accents and c < 0x250 and low.isalpha() and low not in HOMOGLYPHS
        out[c] = low if keep else plain if plain.isalnum() else " "
    out |= _styled()
    for c in range(0x300, 0x370):  # combining marks alone
        out[c] = ""
    for c in range(0xFF01, 0xFF5F):  # full-width forms
        out[c] = chr(c - 0xFEE0).lower()
    for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD):  # invisible, written between letters
        out[c] = ""
    return out


_STANDS_IN = re.compile("[" + re.escape("".join(SUBSTITUTES)) + "]")
#: A stretch with a letter and a stand-in side by side: only there do digits mean letters.
_MIXED = re.compile(r"[a-z0-9@$!]*(?:[a-z][01345 7@$!][a-z]|[@$01345 7][a-z])[a-z0-9@$!]*".replace(" ", ""))
_NOT_LETTERS = re.compile(r"[\W_]+")


def fold(text: str, accents: bool = True) -> str:
    """Lower-case letters, homoglyphs and substitutes folded; words parted by single blanks, blanks at both ends."""
    low = text.lower()
    if not low.isascii():
        low = low.translate(_fold_table(accents))
    if _STANDS_IN.search(low):
        low = _MIXED.sub(lambda m: m.group().rstrip("!").translate(_SUB_TABLE) + " ", low)
    return " " + _NOT_LETTERS.sub(" ", low).strip() + " "


_SUB_TABLE = str.maketrans(SUBSTITUTES)


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the calibration of the score.

    An entry `` word `` (blanks at both ends) is a whole word, `` word``
    is how a word begins.  ``curve`` holds the intercept and the factors
    of the log sum of weights and of the weight per word.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 4.0, 0.0)
    automaton: object = field(default=None, repr=False, compare=False)

    def prepared(self) -> Lexicon:
        if self.automaton is None:
            a = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                a.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                a.add_word(fold(phrase), (len(fold(phrase)), None))
            if len(a):
                a.make_automaton()
            self.automaton = a
        return self

    def found(self, text: str) -> tuple[float, int, int]:
        """Sum of the weights outside exception phrases, their number, and the text's words.

        A word counts once, with its heaviest entry, however many
        beginnings of it are entries too.
        """
        folded = fold(text)
        n_words = max(0, folded.count(" ") - 1)
        if not len(self.prepared().automaton) or not n_words:
            return 0.0, 0, n_words
        best = self._matched(folded)
        if not folded.isascii():
            best = max(best, self._matched(fold(text, accents=False)))
        return *best, n_words

    def phrases(self, text: str) -> set[tuple[str, str]]:
        """Words with an entry outside exceptions, each alone ("", word) and with its neighbours (phrase, word)."""
        folded = fold(text)
        out: set[tuple[str, str]] = set()
        for at in self._places(folded) if len(self.prepared().automaton) else ():
            end = folded.index(" ", at + 1)
            word = folded[at + 1:end]
            out.add(("", word))
            if at:
                out.add((f"{folded[folded.rindex(' ', 0, at) + 1:at]} {word}", word))
            if end + 1 < len(folded):
                out.add((f"{word} {folded[end + 1:folded.index(' ', end + 1)]}", word))
        return out

    def _matched(self, folded: str) -> tuple[float, int]:
        best = self._places(folded)
        return sum(best.values()), len(best)

    def _places(self, folded: str) -> dict[int, float]:
        """Where a word begins that has an entry outside exceptions, and its heaviest entry's weight."""
        shields: list[tuple[int, int]] = []
        best: dict[int, float] = {}
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                shields.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if shields:
            best = {at: w for at, w in best.items() if not any(s <= at < e for s, e in shields)}
        return best

    def features(self, text: str) -> tuple[float, float]:
        """What the curve takes: log(1 + sum of weights), and weight per word (in hundreds, at most 1)."""
        total, _, n_words = self.found(text)
        return math.log1p(total), min(1.0, total / max(20, n_words))

    def score(self, text: str) -> float:
        a, b = self.features(text)
        c0, c1, c2 = self.curve
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, c0 + c1 * a + c2 * b))))


def _patterns(text: str, heads: frozenset[str] | None = None) -> set[str]:
    """The entries a folded text could support: each word whole and by its beginnings.

    With ``heads``, only words that begin with one of these three letters.
    """
    out: set[str] = set()
    for word in set(fold(text).split()):
        if len(word) > 2 and (heads is None or word[:3] in heads):
            out.add(f" {word} ")
            out.update(f" {word[:k]}" for k in PREFIXES if len(word) > k)
    return out


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = (), text_col: str = "text",
          label_col: str = "label") -> Lexicon:
    """Learn a lexicon from rows with a text and a label 0 or 1 (null labels are skipped).

    Document counts per pattern are summed by Spark over all the rows
    given, of which ``training_rows`` bounds the number; only the most
    frequent patterns of toxic rows come to the driver, and from them
    the best ``MOST_ENTRIES``.  With no rows, or no toxic ones, the
    lexicon is empty and every score is low.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                           F.col(label_col).cast("int").alias("label")).where("label is not null")
    totals = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = int(totals["n"] or 0), int(totals["toxic"] or 0)
    if not toxic or toxic == n:
        return Lexicon({}, exceptions)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # toxic rows name the patterns; other rows only count against them
        held: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                for p in _patterns(text):
                    held.setdefault(p, [0, 0])[1 if label else 0] += 1
                if len(held) > 100_000:
                    yield _counted(held)
                    held = {}
        yield _counted(held)

    toxic_rows = rows.where("label = 1")
    named = (toxic_rows.mapInArrow(count, "pattern string, clean long, toxic long").groupBy("pattern")
             .agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCS))
    # the most frequent patterns of toxic rows, a bounded list, are counted in the other rows
    candidates = {r["pattern"]: r["toxic"] for r in
                  named.orderBy(F.desc("toxic"), "pattern").limit(10 * MOST_ENTRIES).collect()}
    shared = labelled.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = shared.value, {}
        heads = frozenset(p[1:4] for p in known)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for p in _patterns(text, heads) & known:
                    held.setdefault(p, [0, 0])[0] += 1
        yield _counted(held)

    clean = {r["pattern"]: r["clean"] for r in
             rows.where("label = 0").mapInArrow(against, "pattern string, clean long, toxic long")
             .groupBy("pattern").agg(F.sum("clean").alias("clean")).collect()}
    weights = {}
    for p, t in candidates.items():
        c = clean.get(p, 0)
        w = math.log((t + 0.1) / (toxic + 1) * (n - toxic + 1) / (c + 0.5))
        share = (t + c) / n
        evidence = t * math.log(t / (toxic * share)) + (c * math.log(c / ((n - toxic) * share)) if c else 0.0)
        if w >= LEAST_WEIGHT and evidence >= math.log(len(candidates)) + EVIDENCE:
            weights[p] = round(w, 4)
    best = sorted(weights.items(), key=lambda x: (-candidates[x[0]] * x[1], x[0]))[:MOST_ENTRIES]
    lexicon = Lexicon(dict(best), (*exceptions, *_learned_exceptions(rows, Lexicon(dict(best), exceptions))))
    held = _features(rows, lexicon, ["label"]).select("label", "a", "b").collect()
    x = np.array([[1.0, r["a"], r["b"]] for r in held])
    lexicon.curve = _fit(x, np.array([r["label"] for r in held], dtype=float))
    lexicon.automaton = None
    return lexicon


def _learned_exceptions(rows: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Phrases around entries that ``LEAST_DOCS`` other documents hold and no toxic one, and that chance does not explain."""
    if not lexicon.weights:
        return ()
    shared = rows.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = Lexicon(*shared.value), {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                for p in own.phrases(text):
                    held.setdefault(p, [0, 0])[1 if label else 0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in held], pa.string()), pa.array([w for _, w in held], pa.string()),
             pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())],
            names=["phrase", "word", "clean", "toxic"])

    counts = rows.mapInArrow(count, "phrase string, word string, clean long, toxic long").groupBy("phrase", "word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") >= LEAST_DOCS)
    # only words that several clean documents hold are left, and of their phrases the most frequent
    told = counts.where((F.col("phrase") == "") | (F.col("toxic") == 0)).orderBy(
        F.desc(F.col("phrase") == ""), F.desc("clean"), "phrase").limit(10 * (MOST_ENTRIES + MOST_EXCEPTIONS)).collect()
    words = {r["word"]: (r["clean"], r["toxic"]) for r in told if not r["phrase"]}
    found = [r for r in told if r["phrase"]]
    out = []
    for r in found:
        clean, toxic = words[r["word"]]
        if toxic and -r["clean"] * math.log(clean / (clean + toxic)) >= math.log(len(found)) + EVIDENCE:
            out.append(r["phrase"])
    return tuple(out[:MOST_EXCEPTIONS])


def _counted(held: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                       pa.array([v[0] for v in held.values()], pa.int64()),
                                       pa.array([v[1] for v in held.values()], pa.int64())],
                                      names=["pattern", "clean", "toxic"])


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, lightly regularised."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 0.05 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(round(float(v), 6) for v in w)


def _features(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """Adds ``a``, ``b`` (the curve's inputs), ``score`` and ``n_hits``; the text is left out."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (lexicon.weights, lexicon.exceptions, lexicon.curve))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(*shared.value)
        c0, c1, c2 = lex.curve
        for batch in batches:
            found = [lex.found(t or "") for t in batch.column("text").to_pylist()]
            total = np.array([f[0] for f in found], dtype=float)
            words = np.array([f[2] for f in found], dtype=float)
            a, b = np.log1p(total), np.minimum(1.0, total / np.maximum(20, words))
            score = 1 / (1 + np.exp(-np.clip(c0 + c1 * a + c2 * b, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(a), pa.array(b), pa.array(score),
                 pa.array([f[1] for f in found], pa.int64())], names=[*keep, "a", "b", "score", "n_hits"])

    return rows.select(*keep, "text").mapInArrow(run, f"{fields}, a double, b double, score double, n_hits long")


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, score, n_hits``, from the whole text and nothing else.

    A null or empty text scores like a text without any entry.
    """
    return _features(texts(docs, id_col, text_col), lexicon, ["doc_id"]).select("doc_id", "score", "n_hits")


def without_toxic(docs: DataFrame, lexicon: Lexicon, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score ``limit`` or more."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions, lexicon.curve))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(*shared.value)
        for batch in batches:
            fine = [lex.score(t or "") < limit for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept out of training: crc32 of its id as text is a multiple of five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = LEARN_ROWS) -> DataFrame:
    """Texts with their toxic label, of at most ``most`` of the rows that may be learned from.

    The labels chosen are a table of bounded size, so it is broadcast and
    the texts are not shuffled.  A document with several labels is toxic
    if one of them says so.
    """
    marked = (labels.where(~held_out() & F.col("toxic").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return texts(docs).join(F.broadcast(marked), "doc_id").select("text", "label")


#: Harmless phrases that hold a word of the lexicon.
EXCEPTIONS = ("clown fish", "clown car", "class clown award", "trash can", "trash collection", "scum line",
              "pond scum", "sore loser penalty")
