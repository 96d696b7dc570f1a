"""Held-out accuracy, the parts against numpy, and the awkward rows."""

import random

import documents as d
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality as q
from tidemark.llm.common import fold_of


def labelled(n=600, seed=3):
    rng = random.Random(seed)
    for i in range(n):
        text, good = d.prose(rng, rng.choice([20, 60, 150])), rng.random() < 0.8
        if not good:
            text = "\n".join(["buy now ### $$$"] * 9) if rng.random() < 0.5 else " ".join(w + "***" for w in text.split())
        yield i, text, int(good)


def test_held_out_documents(spark):
    data = spark.createDataFrame(labelled(), "doc_id long, text string, quality int").withColumn("stats", q.text_statistics("text")).cache()
    model = q.fit(data.filter(fold_of("doc_id", 3) != 1))
    got = data.filter(fold_of("doc_id", 3) == 1).select("quality", q.quality("stats", model).alias("p")).collect()
    assert all(0 <= r.p <= 1 for r in got)
    assert sum((r.p >= 0.5) == bool(r.quality) for r in got) >= 0.97 * len(got)


def test_statistics_of_awkward_texts(spark):
    got = d.table(spark).select("text", q.text_statistics("text").alias("s")).collect()
    for r in got:
        assert len(r.s) == len(q.STATISTICS) and np.isfinite(r.s).all()
        assert any(r.s) == bool((r.text or "").encode().split())
    s = dict(zip(q.STATISTICS, q.statistics(b"ab ab\ncd#\n\nab ab\n")))
    assert (s["distinct_words"], s["most_frequent_word"], s["repeated_lines"]) == pytest.approx((2 / 5, 4 / 5, 1 / 3))
    assert s["symbols"] == pytest.approx(1 / 17)


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, len(q.STATISTICS)))
    y = (x[:, 0] + rng.normal(size=500) > 0).astype(int)
    rows = spark.createDataFrame([(i, list(map(float, a)), int(b)) for i, (a, b) in enumerate(zip(x, y))], "doc_id long, stats array<double>, quality int")
    aside = [r[0] for r in rows.select((F.pmod(F.xxhash64("doc_id", F.lit(q.SEED)), F.lit(4)) == 0)).collect()]
    model = q.fit(rows.repartition(5), features=32)
    fit = ~np.array(aside)
    z = model.features(x[fit])
    penalty = q.RIDGE * fit.sum() * np.eye(33)
    penalty[-1, -1] = 0
    want = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(33), z.T @ y[fit])
    assert model.coef == pytest.approx(want, rel=1e-6, abs=1e-8)


@pytest.mark.parametrize("seed", range(10))
def test_pool_adjacent(seed):
    rng = np.random.default_rng(seed)
    v, w = rng.normal(size=12), rng.integers(1, 5, 12).astype(float)
    # Max-min formula of isotonic regression.
    mean = lambda a, b: (v[a : b + 1] * w[a : b + 1]).sum() / w[a : b + 1].sum()
    want = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert q.pool_adjacent(v, w) == pytest.approx(want)


def test_one_sided_missing_and_no_labels(spark):
    rows = spark.createDataFrame([(1, "a b c", 1), (2, None, 1), (3, "x", None)], "doc_id long, text string, quality int")
    stats = rows.withColumn("stats", q.text_statistics("text"))
    for data, want in ((stats, 1.0), (stats.filter("false"), 0.5)):
        model = q.fit(data)
        assert {r[0] for r in stats.select(q.quality("stats", model)).collect()} == {want}
    assert d.empty(spark).select(q.text_statistics("text")).count() == 0
