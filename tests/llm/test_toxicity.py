"""Operator 2: folding, exceptions, held-out accuracy, and rows that go wrong."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefeed.llm import toxicity
from linefeed.llm.common import table
from linefeed.llm.queries import op2_toxicity


def test_folding_finds_disguised_words():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " stupid ": 5.0, " clown ": 5.0}, ("clown fish",))
    for text in ("an 1d10t", "$tup1d!!", "Clоwn", "ｉｄｉｏｔ", "ïdiöt",
                 "i​diot", "st́upid", "IDIOT"):
        assert lexicon.found(text)[1] == 1, text
    assert lexicon.found("a clown fish swims")[1] == 0
    assert lexicon.found("a clown and a clown fish")[1] == 1
    assert lexicon.found("in 2019 and 100 times")[1] == 0


def test_longer_texts_weigh_the_same_word_less():
    lexicon = toxicity.Lexicon({" idiot ": 5.0}, (), (-3.0, 1.0, 20.0))
    assert lexicon.score("idiot " + "word " * 20) > lexicon.score("idiot " + "word " * 500) > lexicon.score("word")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels").where("toxic is not null")
    got = op2_toxicity(spark, sf).where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("right"),
        F.sum(F.when((F.col("toxic") == 0) & (F.col("predicted") == 1), 1).otherwise(0)).alias("wrongly")).first()
    assert got["right"] > 0.9 and got["wrongly"] <= 2


def test_labels_of_held_out_rows_are_not_read(spark, sf_small):
    docs, labels = table(spark, sf_small, "documents"), table(spark, sf_small, "labels")
    swapped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.learn(toxicity.training_rows(docs, x)) for x in (labels, swapped))
    assert (one.weights, one.curve) == (two.weights, two.curve)


def test_edge_rows(edge, empty):
    lexicon = toxicity.Lexicon({" fox ": 6.0}, (), (-2.0, 2.0, 1.0))
    got = toxicity.score(edge, lexicon).collect()
    assert len(got) == edge.count()
    assert {r["doc_id"] for r in got if r["score"] >= 0.5} == {1, 2, None}
    assert toxicity.without_toxic(edge, lexicon).columns == edge.columns
    assert {r["doc_id"] for r in toxicity.without_toxic(edge, lexicon).collect()} == {3, 4, 5, 6, 7, 8}
    assert toxicity.score(empty, lexicon).count() == 0


def test_nothing_to_learn(spark, edge):
    rows = edge.select("text", F.lit(None).cast("int").alias("label"))
    assert toxicity.learn(rows).weights == {}


def test_folding_finds_styled_letters():
    lexicon = toxicity.Lexicon({" idiot ": 5.0})
    for text in ("\U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d", "ⓘⓓⓘⓞⓣ", "ⒾⒹⒾⓄⓉ", "ℐdiot", "\U0001f138\U0001f133IOT",
                 "\U0001d7cfd\U0001d7cf\U0001d7d8t"):
        assert lexicon.found(text)[1] == 1, text


def test_exceptions_are_learned_from_clean_rows(spark):
    """A word that insults alone and is harmless in one phrase: the phrase becomes an exception, on held-out rows too."""
    import random
    rng = random.Random(4)
    plain = [f"w{i}ord" for i in range(200)]

    def text(*own):
        words = rng.choices(plain, k=30)
        at = rng.randrange(len(words))
        return " ".join([*words[:at], *own, *words[at:]])

    rows = [(text("you", "Clown"), 1) for _ in range(80)] + [(text("clown", "fish"), 0) for _ in range(20)]
    rows += [(text(), 0) for _ in range(300)] + [(text("clown", rng.choice(plain)), 0) for _ in range(2)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, label int"))
    assert "clown fish" in lexicon.exceptions and " clown " in lexicon.weights
    assert not any(e.startswith("you ") for e in lexicon.exceptions)
    held = [(i, text("cl0wn", "fish")) for i in range(50)] + [(100 + i, text("you", "clown")) for i in range(50)]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(
        spark.createDataFrame(held, "doc_id long, text string"), lexicon).collect()}
    assert all((got[i] >= 0.5) == (i >= 100) for i in got)
