"""Packed products and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives as n

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("size", [1, 3, 300, 2**20, 2**31, 2**62])
@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (20, 33, 64), (3, 1, 64)])
def test_packed_products(size, shape):
    k, m, d = shape
    rng = np.random.default_rng(size % 1000 + k)
    a, c = (rng.integers(-size, size, (x, d), dtype=np.int64) for x in (k, m))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
    assert [[int(x) for x in row] for row in n.packed_scores(a, c)] == want
    top = np.full((2, d), size - 1, np.int64)
    assert (n.packed_scores(top, -top).astype(object) == -d * (size - 1) ** 2).all()


def test_packed_products_of_nothing():
    none = np.zeros((0, 4), np.int64)
    assert n.packed_scores(none, none).shape == (0, 0)
    assert n.packed_scores(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).tolist() == [[0] * 3] * 2
    assert n.packed_scores(np.full((2, 3), 5), np.full((4, 3), -2)).tolist() == [[-30] * 4] * 2


def brute(rows):
    """The contract, row by row."""
    use = [
        (i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for at, (i, lab, v) in enumerate(use):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other, k) for k, (j, other, w) in enumerate(use)]
        near = sorted((x for x in scored if x[2] == lab and x[3] != at), key=order)[:5]
        for ps, p, *_ in near:
            hard = sorted((x for x in scored if x[2] != lab and 30 * ps <= 100 * x[0] <= 90 * ps), key=order)[:10]
            out += [(i, p, r + 1, x[1], ps, x[0]) for r, x in enumerate(hard)]
    return sorted(map(repr, out))


def got(spark, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(extra)
    out = n.hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in out.collect())


def vectors(count, dim=8, seed=1, scale=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0.1, 0.4) * scale)) for _ in range(dim)], rng.randrange(3)) for i in range(count)]


@pytest.mark.parametrize("blocks", [(8192, 4096, 128), (50, 2, 1), (17, 1, 3)])
def test_blocks_of_any_size(spark, monkeypatch, blocks):
    for name, size in zip(("CANDIDATES", "ANCHORS", "SLICE"), blocks):
        monkeypatch.setattr(n, name, size)
    rows = vectors(450)
    want = brute(rows)
    assert len(want) > 50 and got(spark, rows) == want


def test_ties_repeats_nulls_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(n, "CANDIDATES", 40)
    same = [0.5, 0.25, 0.5]
    rows = [(i, same, 1) for i in range(0, 60)] + [(i, [0.25, 0.25, 0.25], 2) for i in range(60, 120)]
    rows += [(100, [0.25, 0.25, 0.25], 2), (None, same, 1), (None, [0.25, 0.2, 0.25], 0), (200, None, 1), (300, same, None),
             (400, [0.1, None, 0.2], 1), (500, [0.1, math.nan, 0.2], 1), (600, [math.inf, 0.0, 0.2], 1), (700, [], 1),
             (800, [0.5], 1), (900, [0.5, 0.25, 0.5, 9.0, 1.0], 2), (-100, same, 0)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1e3, 1e6, 1e9])
def test_large_components(spark, scale):
    rows = vectors(130, 5, 3, scale)
    want = brute(rows)
    assert want and (scale > 1e7 or got(spark, rows) == want)
    if scale > 1e7:  # scores beyond a long come back as its nearest end; ranks are still exact
        strip = lambda rs: [tuple(eval(r)[:4]) for r in rs]
        assert sorted(strip(got(spark, rows))) == sorted(strip(want))


def test_no_rows_and_no_anchors(spark):
    assert got(spark, []) == [] and got(spark, vectors(30)[1:]) == []
    assert got(spark, [(0, [1.0], 1), (100, [1.0], 2)]) == []


def test_names_of_the_operator(spark):
    names = ["row", "id", "vector", "is_anchor", "down", "across", "score", "rank", "positives", "anchor"]
    rows = vectors(210)
    assert got(spark, rows, **{c: F.lit(c) for c in names}) == brute(rows)
