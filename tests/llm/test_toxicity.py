"""Held-out accuracy, sentences found, and the awkward rows."""

import random

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as t
from tidemark.llm.common import fold_of, training_labels

INSULTS = ("zblorf", "grumak")


def labelled(n=600, seed=3):
    rng = random.Random(seed)
    for i in range(n):
        text, bad = d.prose(rng, rng.choice([30, 120])), rng.random() < 0.2
        if bad:
            parts = text.split(". ")
            parts[rng.randrange(len(parts))] += f" {rng.choice(INSULTS)}{rng.choice(['', 'en', 'ish'])} thing"
            text = ". ".join(parts)
        yield i, text, int(bad)


def test_held_out_documents_and_sentences(spark):
    data = spark.createDataFrame(labelled(), "doc_id long, text string, toxic int").cache()
    model = t.fit_on_labels(data.select("doc_id", "text"), data.select("doc_id", "toxic"))
    scored = data.filter(fold_of("doc_id", 4) == 2).select("toxic", "text", t.toxicity("text", model).alias("p"),
                                                          t.offending_sentences("text", model).alias("s")).collect()
    assert sum((r.p >= t.THRESHOLD) == bool(r.toxic) for r in scored) >= 0.97 * len(scored)
    found = [r for r in scored if r.toxic and r.s]
    assert len(found) > 15
    for r in found:
        assert all(any(w in r.text[x.start:x.end].lower() for w in INSULTS) for x in r.s)
    kept = t.drop_toxic(data.withColumn("score", F.lit("mine")), model)
    assert kept.columns == ["doc_id", "text", "toxic", "score"] and kept.filter("toxic = 1").count() < 10


@pytest.mark.parametrize("labels, least", [(60, 0.6), (300, 0.9), (3000, 0.95)])
def test_recall_with_few_and_many_labels(spark, labels, least):
    data = spark.createDataFrame(labelled(labels + 800, 11), "doc_id long, text string, toxic int")
    known = data.filter(F.col("doc_id") < labels)
    model = t.fit(known)
    scored = data.filter(F.col("doc_id") >= labels).select("toxic", t.toxicity("text", model).alias("p")).collect()
    found = [r.p >= t.THRESHOLD for r in scored if r.toxic]
    wrong = [r.p >= t.THRESHOLD for r in scored if not r.toxic]
    assert sum(found) >= least * len(found) and sum(wrong) <= 0.03 * len(wrong)


def test_held_out_documents_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = t.fit_on_labels(docs, labels)
    rows = docs.join(labels.filter("toxic is not null"), "doc_id").filter(fold_of("doc_id", 4) == 2)
    scored = rows.select("toxic", (t.toxicity("text", model) >= t.THRESHOLD).alias("hit")).collect()
    hits = [r.hit for r in scored if r.toxic]
    assert sum(hits) >= 0.9 * len(hits) and sum(r.hit for r in scored if not r.toxic) <= 2


def test_repeated_sentences_count_in_training_as_in_scoring(spark):
    """Fifty harmless sentences of one kind must not add up to a toxic document once the model has seen such."""
    calm = [(i, "A plain day here. " * 50, 0) for i in range(40)]
    rude = [(100 + i, "A plain day here. " * 10 + "You zblorf thing.", 1) for i in range(20)]
    model = t.fit(spark.createDataFrame(calm + rude, "doc_id long, text string, toxic int"))
    assert model.document("A plain day here. " * 50) < 0.1 < t.THRESHOLD < model.document("You zblorf thing.")


def test_noisy_or():
    m = t.Model({"bad": 3.0, "good": -1.0}, -2.0)
    one = 1 / (1 + 2.718281828459045 ** -1)
    assert m.document(None) == m.document("") == m.document("nothing here.") == 0.0
    assert abs(m.document("a bad day. fine.") - one) < 1e-9
    assert abs(m.document("a BAD day. bad!") - (1 - (1 - one) ** 2)) < 1e-9
    assert m.offending("Fine. A bad day! Bad") == [
        {"start": 5, "end": 16, "score": m._sentence("bad")}, {"start": 16, "end": 20, "score": m._sentence("bad")}]


def test_one_sided_and_empty_training(spark):
    rows = spark.createDataFrame([(1, "a b", 0), (2, "c d", 0)], "doc_id long, text string, toxic int")
    for data in (rows, rows.filter("false")):
        model = t.fit(data)
        got = d.table(spark).select(t.toxicity("text", model).alias("p")).collect()
        assert {r.p for r in got} == {0.0}
    assert d.empty(spark).select(t.toxicity("text", t.Model({}, 0.0))).count() == 0


def test_training_labels_are_bounded_and_skip_nulls(spark):
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert training_labels(labels, "toxic", 2, 4, 1000).count() == labels.filter(
        "doc_id is not null and toxic is not null").filter(fold_of("doc_id", 4) != 2).count()
    assert training_labels(labels, "toxic", 2, 4, 17).count() == 17
