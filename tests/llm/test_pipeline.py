"""The pipeline: its stages on their own, rows that go wrong, and the registered query."""

from __future__ import annotations

import pytest

import corpus_pipeline
from linefeed.llm import decontaminate, ngram_join, templates
from linefeed.llm.common import table


@pytest.fixture(scope="module")
def kept(spark, sf_small, docs, tmp_path_factory):
    """What each stage is given and returns, by name."""
    at, out = tmp_path_factory.mktemp("stages"), {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, sf_small).write.parquet(str(at / name))
        after = spark.read.parquet(str(at / name))
        out[name] = before, after
        before = after
    return out


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_are_the_ones_asked_for(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination",
                                                      "bpe"]
    for name in list(kept)[:-1]:
        assert kept[name][1].columns == kept[name][0].columns


def test_line_dedup(kept):
    before, after = kept["line_dedup"]
    want = {i: t for i, t, n in templates.brute_force(pairs(before)) if not n or (t or "").split()}
    assert dict(pairs(after)) == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect() if r["text"] is not None)


def test_near_duplicates(kept):
    before, after = kept["near_duplicates"]
    want = {i for i, _, c in ngram_join.brute_force(pairs(before)) if i == c}
    assert {i for i, _ in pairs(after)} == want


def test_decontamination(spark, sf_small, kept):
    before, after = kept["decontamination"]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_small, "benchmark").collect()]
    left = {i for i, _ in pairs(after)}
    gone = [(i, t) for i, t in pairs(before) if i not in left]
    assert {i for i, _, _ in decontaminate.brute_force(gone, items)} == {i for i, _ in gone}
    assert decontaminate.brute_force([(i, t) for i, t in pairs(after)][:30], items) == set()


def test_last_stage_and_query(spark, sf_small, kept):
    got = corpus_pipeline.run(spark, sf_small)
    assert sorted(map(str, got.collect())) == sorted(map(str, kept["bpe"][1].collect()))


def test_edge_rows(spark, sf_small, edge, empty):
    for frame in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_small)
            assert name == "bpe" or out.columns == frame.columns
            assert out.count() <= frame.count()
