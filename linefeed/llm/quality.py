"""Quality rules as a short-circuit cascade (operator 5).

Every rule is a test on one text that rejects or passes it.  On a
sample of the documents each rule's cost (time per text) and selectivity
(part it rejects) are measured by Spark, and the rules are put in the
order of rejections per cost.  A text then meets the rules in this order
until one rejects it.  The order saves time; it never changes a verdict,
because a text is kept only if no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefeed.llm.common import ship, slices, texts

#: Texts the costs are measured on, about; they are chosen by a hash of the id.
SAMPLE_ROWS = 1000
#: Words of a window whose repetition counts.
WINDOW = 8
_SYMBOL = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


@dataclass
class Text:
    """A text and its words, split once for all rules."""

    text: str
    words: list[bytes]


def split(text: str | None) -> Text:
    """The words are the runs free of ASCII white space."""
    return Text(text or "", (text or "").encode("utf-8", "surrogatepass").split())


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of this many words found twice or more in the text, first ones included.

    Windows are numbered by doubling: equal pairs of words get one
    number, then equal pairs of pairs, and so on, so equal numbers mean
    equal words.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(names) == len(words):
        return 0
    width = 1
    while width < window:
        step = min(width, window - width)
        pair = ids[:len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        _, ids = np.unique(pair, return_inverse=True)
        width += step
        if int(ids.max()) + 1 == len(ids):
            return 0
    twice = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.subtract.at(cover, at + window, 1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def symbols(text: str) -> int:
    return len(_SYMBOL.findall(text))


@dataclass(frozen=True)
class Rule:
    """A named test that is true where a text must go."""

    name: str
    rejects: Callable[[Text], bool]


def _word_length(t: Text) -> bool:
    return not 2 <= sum(map(len, t.words)) / max(1, len(t.words)) <= 16


def _symbols(t: Text) -> bool:
    return 10 * symbols(t.text) > len(t.words)


def _shouting(t: Text) -> bool:
    return 10 * len(_UPPER.findall(t.text)) > 4 * len(t.text)


def _one_word(t: Text) -> bool:
    return len(t.words) >= 50 and 4 * Counter(t.words).most_common(1)[0][1] > len(t.words)


def _few_words(t: Text) -> bool:
    return len(t.words) >= 50 and len(set(t.words)) ** 2 < len(t.words)


def _same_in_a_row(t: Text) -> bool:
    w = t.words
    return 5 * sum(a == b for a, b in zip(w, w[1:], strict=False)) > 2 * len(w)


def _lines(t: Text) -> bool:
    lines = [x for x in t.text.split("\n") if x.strip()]
    return len(lines) > 3 and 10 * duplicate_lines(t.text) > 4 * len(lines)


def _no_letters(t: Text) -> bool:
    return 2 * sum(any(c > 64 for c in w) for w in t.words) < len(t.words)


#: The rules, in no particular order.
RULES = (
    Rule("mean word length out of 2 to 16 bytes", _word_length),
    Rule("over a symbol in ten words", _symbols),
    Rule("over 40 percent capital letters", _shouting),
    Rule("one word is over a quarter of the text", _one_word),
    Rule("fewer distinct words than the root of all", _few_words),
    Rule("over 40 percent of words repeat the word before", _same_in_a_row),
    Rule("over 40 percent of lines are repeated", _lines),
    Rule("over half of the words without a letter", _no_letters),
)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
             text_col: str = "text") -> list[tuple[str, float, float]]:
    """Name, seconds per text and part rejected of each rule, on about ``sample_rows`` texts.

    With no rows every figure is 0.
    """
    ship(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    every = max(1, docs.count() // sample_rows)
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text").limit(4 * sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split_texts = [split(t) for t in batch.column("text").to_pylist()]
            rows = []
            for rule in rules:
                began = time.perf_counter()
                hits = sum(rule.rejects(t) for t in split_texts)
                rows.append((rule.name, time.perf_counter() - began, hits, len(split_texts)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)],
                                             names=["name", "seconds", "hits", "n"])

    got = {r["name"]: r for r in sample.mapInArrow(run, "name string, seconds double, hits long, n long").groupBy(
        "name").agg(F.sum("seconds").alias("s"), F.sum("hits").alias("h"), F.sum("n").alias("n")).collect()}
    return [(r.name, got[r.name]["s"] / max(1, got[r.name]["n"]), got[r.name]["h"] / max(1, got[r.name]["n"]))
            if r.name in got else (r.name, 0.0, 0.0) for r in rules]


def ordered(rules: tuple[Rule, ...], figures: list[tuple[str, float, float]]) -> tuple[Rule, ...]:
    """The rules by rejections per cost, most first; ties by name."""
    rank = {name: -part / max(seconds, 1e-9) for name, seconds, part in figures}
    return tuple(sorted(rules, key=lambda r: (rank[r.name], r.name)))


def cascade(docs: DataFrame, rules: tuple[Rule, ...], base: bool = False, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, rejected_by, n_run`` - the rule that rejected the text (null: kept), and rules run.

    With ``base`` also the base counts ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words`` and ``base_failed``; the rules are then
    spared where the base fails.  Null and empty texts have no words.
    """
    names = [r.name for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    t = split(text)
                    counts = ()
                    failed = False
                    if base:
                        n, again = len(t.words), repeated_words(t.words)
                        chars = sum(map(len, t.words)) if text.isascii() else len(b"".join(t.words).decode())
                        failed = n < 20 or 100 * again > 30 * n
                        counts = (n, chars, symbols(text), duplicate_lines(text), again, failed)
                    by, ran = None, 0
                    if not failed:
                        for ran, rule in enumerate(rules, 1):
                            if rule.rejects(t):
                                by = names[ran - 1]
                                break
                    out.append((i, by, ran, *counts))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                                 schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("rejected_by", pa.string()), ("n_run", pa.int32())] + (
        [(c, pa.int64()) for c in BASE] + [("base_failed", pa.bool_())] if base else []))
    ddl = "doc_id long, rejected_by string, n_run int" + (
        "".join(f", {c} long" for c in BASE) + ", base_failed boolean" if base else "")
    return texts(docs, id_col, text_col).mapInArrow(run, ddl)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed`` and ``kept``, by the cascade in its measured order."""
    done = cascade(docs, ordered(rules, measured(docs, rules)), base=True)
    return done.select("doc_id", *BASE, "base_failed",
                       (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"))
