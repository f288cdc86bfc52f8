"""Operator 3: the same tokens as the tokenizers library, and an exact round trip."""

from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from linefeed.llm import bpe
from linefeed.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def vocabulary():
    spec = bpe.read_vocabulary(vocabulary_path())
    return bpe.Vocabulary(spec, bpe.differing_classes(spec))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_documents_encode_as_the_library_does(vocabulary, library, rows):
    texts = [t or "" for _, t in rows]
    assert [vocabulary.encode(t) for t in texts] == [e.ids for e in library.encode_batch(
        texts, add_special_tokens=False)]


def test_random_strings_encode_as_the_library_does(vocabulary, library):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "中", "\U0001f600", "1", "23", "'s", "'", "the", "<|endoftext|>", "\x85",
             "\x1c", "aaaa", "----", "\x00", "İ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_every_code_point_is_split_as_the_library_does(vocabulary, library):
    """Behind a letter, a digit and a mark, before an ending and between blanks; letters differ between Unicode versions."""
    every = [*range(0xD800), *range(0xE000, 0x110000)]
    for at in range(0, len(every), 5000):
        text = "".join(f"{chr(c)}'d 1{chr(c)}'d a{chr(c)}! {chr(c)} !{chr(c)}  {chr(c)}\n" for c in every[at:at + 5000])
        assert vocabulary.split(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_letters_of_other_unicode_versions_encode_as_the_library_does(vocabulary, library):
    for text in ("\U00032568'd", "\U00018fa4't", "\U0003eb48\u8b6e", "\u0558'd1\u0558'd", "a\ua7cfb \u088f\u088f  \u0c5c"):
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_a_long_run_stays_linear_and_right(vocabulary, library):
    for text in ("a" * 20000, "ab" * 7000, "=" * 9999):
        assert list(vocabulary.encode_piece(text)) == library.encode(text, add_special_tokens=False).ids


def test_query_digests(spark, edge, library):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.token_digests(edge, vocabulary_path()).collect()}
    want = set()
    for r in edge.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.add((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want


def test_columns_are_kept_and_clashes_give_way(edge, empty):
    out = bpe.encode(edge, vocabulary_path())
    assert set(out.columns) == (set(edge.columns) - {"text"}) and out.count() == edge.count()
    back = bpe.decode(out, vocabulary_path())
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in edge.collect())
    assert bpe.encode(empty, vocabulary_path()).count() == 0
