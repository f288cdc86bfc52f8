"""Operator 11: ids as the library gives them, bins as plain best-fit decreasing opens them, places without gaps."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from linefeed.llm import packing
from linefeed.llm.queries import op11_packing

VOCABULARY = path("word_bpe_49k.json")


def expected(rows):
    library = Tokenizer.from_file(VOCABULARY)
    out = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[at:at + 2048], dtype="<u4")
            out.append((i, n, at, len(cut), zlib.crc32(cut.tobytes())))
    return out


def ids_of(tokens, texts):
    flat, ends = tokens.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def check_places(got, capacity=2048):
    """Every sequence is filled from 0 on without gaps, and no sequence is too long."""
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(spark, sf_small, rows):
    got = op11_packing(spark, sf_small).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(
        expected(rows))
    assert check_places(got) == packing.brute_force([r["length"] for r in got])


def test_edge_rows_and_clashing_columns(spark, edge):
    got = packing.packed_digest(edge, VOCABULARY).collect()
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    want = expected(rows)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(want)
    assert check_places(got) == packing.brute_force([w[3] for w in want])


def test_blanks_of_all_kinds_split_alike():
    library, chunks = Tokenizer.from_file(VOCABULARY), packing._tokens(open(VOCABULARY, encoding="utf-8").read())
    marks = [chr(c) for c in (*range(0x21), 0x7F, 0x85, 0xA0, 0x300, 0x301, 0x1680, 0x2000, 0x2001, 0x2028, 0x3000,
                              0x200B, 0xFEFF)]
    for m in marks:
        for text in (f"Caf{m}e x", f"don{m}'t {m}{m} 's", f"é{m} ́a{m}", f"<|endoftext|>{m}end", f"ΣΑΣ{m}ΣΑΣ {m}한글",
                     f"\n{m}\r 12{m}3", f"{m} ̧́z"):
            assert ids_of(chunks, [text])[0] == library.encode(text, add_special_tokens=False).ids, (m, text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    library, chunks = Tokenizer.from_file(VOCABULARY), packing._tokens(open(VOCABULARY, encoding="utf-8").read())
    try:
        text.encode()
    except UnicodeEncodeError:
        return  # Spark has no such strings
    assert ids_of(chunks, [text])[0] == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200), st.integers(40, 64))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    runs, bins = packing.best_fit_decreasing(Counter(lengths), capacity)
    assert bins == packing.brute_force(lengths, capacity)
    room = defaultdict(list)
    for run, nxt in zip(runs, [*runs[1:], None], strict=False):
        last = nxt.first if nxt and nxt.length == run.length else Counter(lengths)[run.length]
        for i in range(run.first, last):
            room[run.bin + (i - run.first) // run.per_bin].append(
                (run.offset + (i - run.first) % run.per_bin * run.length, run.length))
    assert sum(map(len, room.values())) == len(lengths) and len(room) == bins
    for members in room.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity


def test_plan_does_not_grow_with_the_rows():
    few = Counter(np.random.default_rng(5).integers(1, 2049, 20_000).tolist())
    small = len(packing.best_fit_decreasing(few)[0])
    large, bins = packing.best_fit_decreasing({n: c * 1_000_003 for n, c in few.items()})
    assert len(large) < 3 * small and bins >= sum(n * c for n, c in few.items()) * 1_000_003 / 2048


def test_sequences_hold_the_ids(spark, docs):
    cut = packing.pieces(docs.limit(60), VOCABULARY)
    placed = packing.place(cut)
    ids = {(r["doc_id"], r["piece"]): r["ids"] for r in cut.collect()}
    for r in packing.sequences(placed).collect():
        assert r["ids"] == b"".join(ids[m["doc_id"], m["piece"]] for m in r["members"])
        assert len(r["ids"]) == 4 * r["length"] and r["length"] <= 2048


def test_no_rows_and_wrong_lengths(spark, empty):
    assert packing.packed_digest(empty, VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.best_fit_decreasing({2049: 1})
    with pytest.raises(Exception, match="lengths must be"):
        packing.place(spark.createDataFrame([(0,)], "length long")).count()


def test_latin_words_and_marks_are_put_together_rightly():
    library, chunks = Tokenizer.from_file(VOCABULARY), packing._tokens(open(VOCABULARY, encoding="utf-8").read())
    letters = [chr(c) for c in (*range(0x21, 0x250), 0x1E9E, 0x212A, 0x212B, 0xFB01, 0x2028, 0x3A3, 0x1C80)
               if not chr(c).isspace()]
    texts = [f"{c} a{c} {c}b A{c}B {c}{c}. {c}'s {c}#$ x{c}!_ {c}́" for c in letters]
    for text, ids in zip(texts, ids_of(chunks, texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text
