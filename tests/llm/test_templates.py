"""Operator 4: templates and dropped lines against brute force."""

from __future__ import annotations

import random

from linefeed.llm import templates


def test_templates_generalise_variable_words():
    lines = [(b"dear ann your order <*> has been sent today", [1]), (b"dear bob your order <*> has been sent today", [2]),
             (b"dear ann nothing here is like the other one", [3])]
    assert templates.grown(lines) == [0, 0, 1] or templates.grown(lines) == [1, 1, 0]


def test_against_brute_force(spark, rows):
    rng = random.Random(5)
    names = ["Ann", "Bob", "Carl", "Dora", "Eve"]
    data = [*rows, *((5000 + i, f"As you asked, {rng.choice(names)}, order {i} has been sent today\nline {rng.random()}\n"
                      f"word{i} only here\nsee you soon\nAll rights reserved.") for i in range(40))]
    data += [(6000, data[-1][1]), (6001, None), (6002, ""), (None, data[-1][1])]
    got = templates.drop_lines(spark.createDataFrame(data, "doc_id long, text string"), chunk_bytes=100_000)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(templates.brute_force(data), key=str)
    first = {r["doc_id"]: r["text"] for r in got.where("doc_id in (5000, 5039, 6000)").collect()}
    assert "order 0 has been sent" in first[5000] and "\n" not in first[6000] and first[5039] == first[6000] and first[6000].startswith("line 0.")


def test_lines_in_few_documents_stay(spark):
    data = [(i, f"the same line in all\nown line {i}") for i in range(templates.LEAST_DOCS - 1)]
    got = templates.drop_lines(spark.createDataFrame(data, "doc_id long, text string"), least_words=4).collect()
    assert sum(r["dropped_lines"] for r in got) == 0


def test_edge_rows(edge, empty):
    got = templates.drop_lines(edge)
    assert sorted(got.columns) == sorted(edge.columns) and got.count() == edge.count()
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {r["doc_id"]: r["text"] for r in edge.collect()}
    assert templates.drop_lines(empty).count() == 0


def test_templates_of_very_many_texts(spark):
    rng = random.Random(7)
    data = [(i, f"As you asked, name{chr(97 + i % 26)}{'xyz'[i // 26 % 3]}{'pqrst'[i // 78]}, order {i} has been sent today\nown {rng.random()}")
            for i in range(300)]
    data += [(400 + i, "As you asked, " + " ".join(rng.choice("abcdefgh") for _ in range(7))) for i in range(300)]
    got = templates.drop_lines(spark.createDataFrame(data, "doc_id long, text string"), chunk_bytes=4_000).collect()
    assert sorted(map(tuple, got)) == sorted(templates.brute_force(data))
    assert sum("has been sent" in r["text"] for r in got) == 1


def test_templates_found_by_index_are_those_of_trying_each():
    def each(lines, similar=templates.SIMILAR):
        held, out = [], [0] * len(lines)
        for i in sorted(range(len(lines)), key=lambda i: (-len(lines[i][1]), lines[i][0])):
            words = lines[i][0].split(b" ")
            fits = [(-sum(a == b for a, b in zip(t, words)), t.count(templates.FIELD), k) for k, t in enumerate(held)]
            best = min(fits, default=(0, 0, 0))
            if -best[0] >= similar * len(words):
                held[best[2]] = [a if a == b else templates.FIELD for a, b in zip(held[best[2]], words)]
                out[i] = best[2]
            else:
                out[i] = len(held)
                held.append(words)
        return out

    rng = random.Random(8)
    for _ in range(200):
        n, kinds = rng.randint(3, 14), rng.randint(2, 6)
        lines = {b" ".join(rng.choice([b"<*>", *(b"%c" % (97 + k) for k in range(kinds))]) for _ in range(n))
                 for _ in range(rng.randint(1, 80))}
        lines = [(x, list(range(rng.randint(1, 5)))) for x in sorted(lines)]
        assert templates.grown(lines) == each(lines)


def test_long_lines_go_from_two_texts_on(spark):
    def passage(n):
        return " ".join(f"{w}{'abcdefgh'[n]}" for w in ("many", "words", "that", "stand", "in", "one", "line") * 8)

    data = [(10 * n + k, f"own{n}{k} line\n{passage(n)}\n{'abcdefgh'[n]} short line") for n in (2, 3, 4) for k in range(n)]
    got = templates.drop_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["dropped_lines"] for r in got} == {
        10 * n + k: int(k > 0) for n in (2, 3, 4) for k in range(n)}
    assert sorted(map(tuple, got)) == sorted(templates.brute_force(data))
