"""Cutting hot keys must not change any result."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from tidemark.operators import features as ft
from tidemark.operators.quantiles import exact_quantile
from tidemark.operators.skew import hot_blocks, positions, spread


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [("hot", i, rng.randrange(100)) for i in range(4000)]
    data += [(f"k{i % 40}", i * 7, rng.randrange(100)) for i in range(2000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, seq long, v long").repartition(6).cache()


def frames(df, w):
    return df.select(
        "key", "seq", F.sum("v").over(w.rowsBetween(-23, 0)).alias("a"), F.sum("v").over(w.rowsBetween(1, 12)).alias("b"),
        F.count("v").over(w.rowsBetween(-23, 12)).alias("n"), *[c for c in df.columns if c.startswith("run_")])


@pytest.mark.parametrize("width", [1, 10, 64, 700])
@pytest.mark.parametrize("min_rows", [100, 37, 3000, 10**6])
def test_spread_equals_a_plain_window(rows, width, min_rows):
    plain = {tuple(r) for r in frames(rows, W.partitionBy("key").orderBy("seq")).collect()}
    runs = spread(rows, "key", ["seq"], F.floor(F.col("seq") / width), 23, 12, min_rows)
    cut = runs.__class__(frames(runs.df, runs.window), runs.window).done().collect()
    assert len(cut) == len(plain) and {tuple(r) for r in cut} == plain


def test_blocks_are_bounded(rows):
    hot = hot_blocks(rows, "key", F.floor(F.col("seq") / 10), 23, 0, 500).collect()
    assert {r["hot_key"] for r in hot} == {"hot"} and len(hot) == 400
    assert {r["block"] for r in hot} == set(range(8))
    # A bucket of ten rows is seen by its own block, and near a border by the next one.
    assert all(r["first_block"] == r["block"] <= r["last_block"] <= r["block"] + 1 for r in hot)
    assert sum(r["last_block"] > r["block"] for r in hot) == 7 * 23


def test_positions(rows):
    got = positions(rows, "key", ["seq"], F.floor(F.col("seq") / 64)).select("key", "seq", "pos", "key_rows").collect()
    w = W.partitionBy("key")
    want = rows.select("key", "seq", (F.row_number().over(w.orderBy("seq")) - 1).alias("pos"),
                       F.count("*").over(w).alias("key_rows")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_features_and_samples_of_a_hot_dataset(spark):
    rng = random.Random(3)
    data = [("hot", 3600 * i, rng.randrange(200), rng.randrange(9), 1, i % 24, 0) for i in range(900)]
    data += [("small", 3600 * i, rng.randrange(200), rng.randrange(9), 1, i % 24, 0) for i in range(150)]
    access = spark.createDataFrame(data, "dataset_id string, timestamp long, reads_1h long, writes_1h long, "
                                         "bytes_read_1h long, hour_of_day int, day_of_week int").repartition(5).cache()
    pairs = []
    for min_rows in (10**6, 200):
        table = ft.training_table(access, min_rows)
        rows = ft.feature_rows(table, "reads")
        samples = ft.sequence_samples(rows, [c for c in rows.columns if c.startswith("f_")], 12, min_rows=min_rows)
        pairs.append([sorted(map(str, df.collect())) for df in (table, samples, ft.backtest(access, 8, min_rows=min_rows))])
    assert pairs[0] == pairs[1]
    assert len(pairs[0][1]) == (900 - 35) + (150 - 35)


@pytest.mark.parametrize("shape", ["ties", "uniform", "tail", "small", "hundred"])
def test_exact_quantiles(spark, shape):
    rng = random.Random(1)
    xs = {
        "ties": [5.0] * 3000 + [rng.random() * 10 for _ in range(3000)],
        "uniform": [rng.random() for _ in range(5000)],
        "tail": [rng.paretovariate(0.5) for _ in range(5000)],
        "small": [3.0, 1.0, 2.0],
        "hundred": [float(i) for i in range(1, 101)],
    }[shape]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double").repartition(5)
    for p in (0.95, 0.5, 0.01):
        want = statistics.quantiles(xs, n=100)[round(p * 100) - 1] if len(xs) >= 100 else max(xs)
        row = exact_quantile(df, "x", p).collect()[0]
        assert row["n"] == len(xs) and row["value"] == pytest.approx(want, rel=1e-12)
        assert exact_quantile(df, "x", p, "inclusive").collect()[0]["value"] == pytest.approx(np.quantile(xs, p), rel=1e-12)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(exact_quantile(df, "x", 0.95).collect()[0]) == (0, None)


def test_quantile_of_1_to_100(spark):
    assert exact_quantile(spark.range(1, 101), "id", 0.95).collect()[0]["value"] == pytest.approx(95.95)
