"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's score is logistic in the weights of its words, each of which counts as itself and by its first letters, so
that an unseen form of a known stem is recognised. A document is toxic if any sentence is (noisy-or):
``1 - prod(1 - p_sentence)``. The weights are fitted by gradient descent on the document likelihood, so the label of a
document is shared out among its sentences, and the fitted sentence scores locate what is offending. Training and scoring count
a repeated sentence as often as it occurs.

The features are the ``VOCABULARY`` most surely associated with the label, however many labels there are. A weight starts at
the feature's log odds times their reliability and is held towards 0 by a normal prior, whose force against the labels falls
as labels are added; so a small training set gives a cautious model, not an empty one.

Defined results: a null or empty text has no sentence and the score 0; a word is a run of letters, any case; unlabelled,
repeated and conflicting labels are allowed (rows with a null id or label are left out, repeats count). An empty or
one-sided training set gives the model that scores 0. Other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import saved, training_labels, values

#: Features with the strongest association with the label that the model keeps.
VOCABULARY = 256
#: Log odds whose z is the root of this start at half their size; deviation of the weights' prior.
HALF_Z2, SPREAD = 4.0, 2.0
#: Lengths of word beginnings that are features.
PREFIXES = (4, 5)
#: Words whose weight a worker remembers.
MEMO = 150_000
#: Labelled documents the model is fitted on, at most.
MAX_TRAIN = 20_000
MIN_DOCS = 2
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def features(word: str) -> list[str]:
    """The word itself and its beginnings, which are marked as such."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


class Model:
    """Weight per feature of a word, and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._known: dict[str, float | None] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def _word(self, word: str) -> float | None:
        """The weight of a word, none if the model has no feature of it."""
        if len(self._known) > MEMO:
            self._known.clear()
        found = [self.weights[f] for f in features(word) if f in self.weights]
        self._known[word] = out = sum(found) if found else None
        return out

    def _sentence(self, text: str) -> float:
        known, total, any_ = self._known, self.bias, False
        for w in set(WORD.findall(text)):
            x = known[w] if w in known else self._word(w)
            if x is not None:
                total += x
                any_ = True
        return 1.0 / (1.0 + exp(-min(30.0, max(-30.0, total)))) if any_ else 0.0

    def document(self, text: str | None) -> float:
        """Noisy-or over the sentences. A sentence without a feature of the model has score 0."""
        clean = 1.0
        for part in SENTENCE.findall((text or "").lower()):
            clean *= 1.0 - self._sentence(part)
        return 1.0 - clean

    def offending(self, text: str | None, least: float = 0.5) -> list[dict]:
        """Sentences with at least the given score: start and end (code points, end exclusive) and score."""
        parts = ((m.start(), m.end(), self._sentence(m.group().lower())) for m in SENTENCE.finditer(text or ""))
        return [{"start": s, "end": e, "score": p} for s, e, p in parts if p >= least]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def associated_features(docs: DataFrame, label: str, text: str = "text", keep: int = VOCABULARY) -> list[tuple[str, float]]:
    """Features whose presence goes with the label, surest first, with their smoothed log odds times their reliability. Only the
    ``keep`` first come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts of one task, so that the shuffle sees a word once per task and flush.
        counts: dict[str, list[int]] = {}

        def flush():
            names = list(counts)
            table = np.array(list(counts.values()), np.int64).reshape(-1, 2)
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(table[:, 0]), pa.array(table[:, 1])], names=["word", "neg", "pos"]
            )

        for batch in batches:
            for t, y in zip(values(batch.column(0)), values(batch.column(1))):
                for f in {f for w in set(WORD.findall((t or "").lower())) for f in features(w)}:
                    counts.setdefault(f, [0, 0])[y] += 1
                if len(counts) > 200_000:
                    yield flush()
        if counts:
            yield flush()

    rows = docs.select(text, F.col(label).cast("int").alias("y"))
    per_word = rows.mapInArrow(count, "word string, neg long, pos long").groupBy("word").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos")
    )
    total = docs.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    if not total[0] or not total[1]:
        return []
    odds = F.log((F.col("pos") + 0.5) / (F.lit(total[1]) - F.col("pos") + 0.5)) - F.log(
        (F.col("neg") + 0.5) / (F.lit(total[0]) - F.col("neg") + 0.5)
    )
    spread = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    strongest = (
        per_word.filter(F.col("pos") + F.col("neg") >= MIN_DOCS).select("word", odds.alias("odds"), (odds / spread).alias("z"))
        .orderBy(F.desc(F.abs("z")), "word").limit(keep)
    )
    return [(r.word, r.odds * r.z * r.z / (r.z * r.z + HALF_Z2)) for r in strongest.collect()]


def fit(docs: DataFrame, label: str = "toxic", text: str = "text", keep: int = VOCABULARY, steps: int = 300,
        spread: float = SPREAD) -> Model:
    """Train on all rows of ``docs(text, label)``. What is gathered of a document are the features of the model in its
    different sentences and how often each occurs, so the number of rows has to be bounded, see ``MAX_TRAIN``."""
    docs = docs.filter(F.col(label).isNotNull()).select(text, label)
    odds = associated_features(docs, label, text, keep)
    if not odds:
        return Model({}, -30.0)
    index = {w: i for i, (w, _) in enumerate(odds)}

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, times = [], []
            for t in batch[text]:
                seen: dict[tuple[int, ...], int] = {}
                for part in SENTENCE.findall((t or "").lower()):
                    found = tuple(sorted(index[f] for w in set(WORD.findall(part)) for f in features(w) if f in index))
                    if found:
                        seen[found] = seen.get(found, 0) + 1
                out.append([list(s) for s in seen])
                times.append(list(seen.values()))
            yield pd.DataFrame({"y": batch[label].astype(int), "bags": out, "times": times})

    rows = docs.mapInPandas(bags, "y int, bags array<array<int>>, times array<int>").collect()

    y = np.array([r.y for r in rows], float)
    sentence_doc, entry_sentence, entry_word = [], [], []
    for d, r in enumerate(rows):
        for bag in r.bags:
            entry_sentence += [len(sentence_doc)] * len(bag)
            entry_word += bag
            sentence_doc.append(d)
    doc, sent, word = (np.array(x, np.int64) for x in (sentence_doc, entry_sentence, entry_word))
    times = np.array([n for r in rows for n in r.times], float)
    # A sentence alone is almost never toxic.
    theta = np.concatenate(([o for _, o in odds], [-6.0]))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        x = np.bincount(sent, theta[word], len(doc)) + theta[-1]
        p = _sigmoid(x)
        clean = np.bincount(doc, times * np.log1p(-np.minimum(p, 1 - 1e-9)), len(y))
        toxic = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        # d loss / d x = p (1 - y / P) for the noisy-or likelihood.
        slope = times * p * (1 - (y / toxic)[doc]) if len(doc) else p
        grad = np.concatenate((np.bincount(word, slope[sent], len(odds)), [slope.sum()])) / max(1, len(y))
        grad[:-1] += theta[:-1] / (spread**2 * max(1, len(y)))
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({w: float(t) for (w, _), t in zip(odds, theta)}, float(theta[-1]))


def toxicity(text: Column | str, model: Model) -> Column:
    """The score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([float(model.document(t)) for t in values(texts)], pa.float64())

    return run(text)


def offending_sentences(text: Column | str, model: Model, least: float = 0.5) -> Column:
    """The sentences that score at least ``least``: array of (start, end, score)."""

    @F.arrow_udf("array<struct<start:int,end:int,score:double>>")
    def run(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.array([model.offending(t, least) for t in values(texts)], kind)

    return run(text)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    return docs.filter(toxicity("text", model) < threshold)


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """The model from labelled rows outside the held-out fold (remainder 2 of 4), ``max_train`` at most."""
    picked = training_labels(labels, "toxic", 2, 4, max_train)
    return fit(saved(docs.select("doc_id", "text").join(picked, "doc_id"), "toxicity-training"))
