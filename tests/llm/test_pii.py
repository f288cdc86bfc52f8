"""Operator 10: base spans against the plain patterns, and the field against enumeration."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc
from itertools import product

import pytest

from linefeed.llm import pii

PLAIN = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    def fine(kind, span):
        digits = re.sub("[^0-9]", "", span)
        return (True, kind != 1 or all(int(p) <= 255 for p in span.split(".")),
                12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[kind]
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if fine(k, m.group()))


def test_base_spans_are_those_of_the_plain_patterns(rows):
    rng = random.Random(2)
    parts = ["a", "b", ".", "@", "-", "+", "1", "2", "255", "0", "4111111111111111", " ", "(", ")", "_", "%", "é", "@a.b"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))
        assert pii.base_spans(text) == plain(text), text
    for _, text in rows:
        assert pii.base_spans(text or "") == plain(text or "")


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 100_000, "1 " * 60_000, "@" * 50_000):
        pii.spans(text, pii.Field({(0, "bias"): -1.0}))


def test_dynamic_program_finds_the_best_segmentation():
    rng = random.Random(3)
    for _ in range(40):
        text = " ".join(rng.choice(["12", "a1", "9.9", "+1", "x@y", "(at)"]) for _ in range(rng.randint(1, 4)))
        words = pii.regions(text)[0]
        names = {x for i in range(len(words)) for j in range(i, len(words))
                 for x in pii.features(text, words[i][0], words[j][1])}
        field = pii.Field({(k, x): rng.uniform(-1, 1) for k in range(5) for x in sorted(names)})

        def score(found, field=field, text=text, words=words):
            return sum(field.weights.get((k, x), 0.0) for a, b, k in found
                       for x in pii.features(text, words[a][0], words[b][1]))

        def all_of(n, at=0):
            if at == n:
                yield []
                return
            for rest in all_of(n, at + 1):
                yield rest
            for end, kind in product(range(at, n), range(5)):
                for rest in all_of(n, end + 1):
                    yield [(at, end, kind), *rest]

        at, end = {a: i for i, (a, _) in enumerate(words)}, {b: i for i, (_, b) in enumerate(words)}
        found = [(at[a], end[b], k) for a, b, k in field.best(text, words)]
        assert score(found) == pytest.approx(max(map(score, all_of(len(words)))))


def whole(field, text, words):
    """The segmentation by one program over all words, nothing settled on the way."""
    cells = field._lattice(text, words)
    best, back = [0.0], [None]
    for j in range(len(words)):
        top, how = best[j], None
        for size in range(1, min(pii.MOST_WORDS, j + 1) + 1):
            for kind, x in enumerate(cells[j, size][1]):
                if best[j + 1 - size] + x > top:
                    top, how = best[j + 1 - size] + x, (size, kind)
        best.append(top)
        back.append(how)
    return field._chosen(words, back)


def test_settling_on_the_way_changes_nothing():
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join(rng.choice(["12", "a1", "9.9", "+1", "x@y", "7", "key=1"]) for _ in range(rng.randint(1, 60)))
        words = pii.regions(text)[0]
        names = sorted({x for i in range(len(words)) for j in range(i, min(len(words), i + 6))
                        for x in pii.features(text, words[i][0], words[j][1])})
        field = pii.Field({(k, x): rng.uniform(-1, .35) for k in range(5) for x in names if rng.random() < .7})
        assert list(field.best(text, words)) == whole(field, text, words)


def test_long_numeric_texts_take_bounded_memory_and_linear_time():
    rng = random.Random(7)
    field = pii.Field({(1, "four"): 5.0, (1, "bias"): -3.0, (2, "bias"): -4.0, (2, "plain digits, checked=True"): 5.0})
    took = []
    for n in (200_000, 800_000):
        text = " ".join(str(rng.randrange(10 ** rng.randint(1, 9))) for _ in range(n // 6))
        began = time.process_time()
        tracemalloc.start()
        pii.spans(text, field)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        took.append(time.process_time() - began)
        assert peak < 20 << 20 and peak < 30 * len(text)
    assert took[1] < 8 * took[0]


def test_near_variants_are_found(spark):
    """Addresses, numbers and keys the base patterns do not know, planted in texts the field was not trained on."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field, rng = pii.learned(docs), random.Random(11)
    plain_words = ["the", "order", "of", "them", "and", "when", "a", "house", "12", "3", "2024"]

    def digits(n):
        return "".join(str(rng.randrange(10)) for _ in range(n))

    def card():
        body = digits(15)
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    kinds = {
        "email": lambda: f"{rng.choice(['ann', 'bob.k', 'z_9'])}{rng.choice(['(at)', '[at]'])}site{rng.randrange(9)}.example.com",
        "card": lambda: rng.choice("./").join(re.findall("....", card())),
        "phone": lambda: rng.choice(["0{} {}", "(0{}) {}", "00{} {}"]).format(digits(3), digits(8)),
        "secret": lambda: "key=" + "-".join(re.findall("." * 8, "".join(rng.choice("0123456789abcdef") for _ in range(32))))}
    found = dict.fromkeys(kinds, 0)
    for kind, make in kinds.items():
        planted = 0
        while planted < 100:
            span = make()
            text = " ".join([*rng.choices(plain_words, k=12), span, *rng.choices(plain_words[:8], k=12)])
            a = text.index(span) + 4 * (kind == "secret")
            if any(x < a + len(span) and y > a for x, _, y in pii.base_spans(text)):
                continue  # its digits pass the checksum together with their neighbours'
            planted += 1
            found[kind] += any(pii.KINDS[k] == kind and x <= a + 6 and y >= text.index(span) + len(span) - 6
                               for x, k, y in pii.spans(text, field)[1])
    print(found)
    assert min(found.values()) >= 60, found


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    secrets = 0
    for r in pii.pii_digest(docs).collect():
        base = plain(texts[r["doc_id"]])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for _, k, _ in base) for x in range(4)]
        shown = r["spans"].split(",") if r["spans"] else []
        assert set(listed.split(",") if listed else []) <= set(shown)
        for extra in set(shown) - set(listed.split(",")):
            kind, a, b = extra.split(":")
            secrets += kind == "secret" and bool(re.fullmatch("[0-9a-fA-F]{32,}", texts[r["doc_id"]][int(a):int(b)]))
    assert secrets > 10


def test_edge_rows(edge, empty):
    got = pii.pii_digest(edge).collect()
    assert len(got) == edge.count() and all(r["n_card"] == 0 for r in got)
    assert pii.pii_digest(empty).count() == 0
