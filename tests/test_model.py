"""A trained forecaster beats the mean on seasonal load, for both losses."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.operators import linear, model
from tidemark.operators.forecast import trailing_windows
from tidemark.operators.metrics import forecast_errors
from tidemark.operators.skew import spread
from tidemark.sources.files import staged


@pytest.fixture(scope="module")
def split(spark):
    rows = [
        (f"d{k}", 3600 * i, int(100 * (k + 1) * (1.2 + math.sin(i * math.pi / 12))), i % 5, 1024, i % 24, (i // 24 + 3) % 7)
        for k in range(3) for i in range(24 * 14)
    ]
    access = spark.createDataFrame(rows, "dataset_id string, timestamp long, reads_1h long, writes_1h long, "
                                         "bytes_read_1h long, hour_of_day int, day_of_week int")
    return staged(ft.chronological_split(staged(ft.training_table(access))))


@pytest.mark.parametrize("loss", ["squaredError", "huber"])
def test_beats_the_mean(split, loss):
    samples = model.prepare(split, "reads", 12)
    # Sequences stay on their side of the split: 268 and 68 rows per dataset, 35 of them without a full window.
    counts = {r["is_train"]: r["count"] for r in samples.data.groupBy("is_train").count().collect()}
    assert counts == {True: 3 * (268 - 35), False: 3 * (68 - 35)}
    predicted = model.predict(model.train(samples, loss, max_iter=30), samples)
    error = forecast_errors(predicted, "target", "prediction").first()
    mean = samples.data.filter("is_train").agg(F.avg("target")).first()[0]
    naive = forecast_errors(predicted.withColumn("m", F.lit(mean)), "target", "m").first()
    assert error.n == counts[False] and error.mae < naive.mae / 4


@pytest.mark.parametrize("loss", ["squaredError", "huber"])
def test_one_pass_for_all_targets_equals_numpy(spark, loss):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 30))
    y = x @ rng.normal(size=(30, 3)) + rng.standard_t(2, size=(400, 3)) + [1.0, -2.0, 0.5]
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>").repartition(5)
    found = linear.fit(df, 30, 3, loss, reg=0.05)
    n = len(x)
    for t in range(3):
        weight, w, b = np.ones(n), None, None
        for _ in range(1 + (linear.REWEIGHTINGS if loss == "huber" else 0)):
            mean_x, mean_y = weight @ x / weight.sum(), weight @ y[:, t] / weight.sum()
            xc, yc = x - mean_x, y[:, t] - mean_y
            w = np.linalg.solve((xc * weight[:, None]).T @ xc / n + 0.05 * np.eye(30), (xc * weight[:, None]).T @ yc / n)
            b = mean_y - w @ mean_x
            far = np.abs(y[:, t] - x @ w - b)
            weight = np.where(far <= linear.DELTA, 1.0, linear.DELTA / far)
        assert np.allclose(found.coefficients[t], w, atol=1e-8) and abs(found.intercepts[t] - b) < 1e-8
    row = df.select("x", found.predict(1).alias("p")).first()
    assert row.p == pytest.approx(np.dot(found.coefficients[1], row.x) + found.intercepts[1])


@pytest.mark.parametrize("loss", ["squaredError", "huber"])
def test_short_vectors_are_read_once_for_all_targets(spark, loss):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    y = x @ rng.normal(size=(2, 3)) + rng.standard_t(2, size=(300, 3))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>").repartition(3)
    df = staged(df)
    group = f"fit-{loss}"
    spark.sparkContext.setJobGroup(group, "readings of the rows")
    found = linear.fit(df, 2, 3, loss, reg=0.05)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("others", "all others")
    # A reading takes two jobs under adaptive execution. One matrix per target and reweighting took seven readings.
    assert jobs <= 2 * (3 if loss == "huber" else 1)
    # The same rows through matrices.
    most, linear.MOST_SUMS = linear.MOST_SUMS, 0
    try:
        other = linear.fit(df, 2, 3, loss, reg=0.05)
    finally:
        linear.MOST_SUMS = most
    assert np.allclose(found.coefficients, other.coefficients, atol=1e-8) and np.allclose(found.intercepts, other.intercepts, atol=1e-8)


@pytest.mark.parametrize("hours", [8, 12, 24])
def test_windows_after_each_row_equal_those_of_the_history(spark, hours):
    rows = [("d", 3600 * i, (7 * i * i) % 11, None if i == 4 else i % 5, 1024, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "dataset_id string, timestamp long, reads_1h long, writes_1h long, bytes_read_1h long, size_gb double")
    got = {r.timestamp // 3600: r for r in trailing_windows(spread(df, "dataset_id", ["timestamp"], F.col("timestamp"), largest=30), hours).done().collect()}
    for i in range(30):
        for k, at in (("reads", 2), ("writes", 3)):
            values = [float(r[at] or 0) for r in rows[max(0, i - hours + 1):i + 1]]
            n = len(values)
            older = values[n - 12:n - 6] if n >= 12 else values[:max(1, n // 2)]
            assert got[i].n == n and got[i][f"older_{k}"] == pytest.approx(sum(older) / len(older))


def test_joint_forecast_with_all_inputs(split):
    rows = model.joint_forecast(split, 8, losses=("huber",)).collect()
    assert [r.target for r in rows] == ["reads", "writes", "bytes_read"] and {r.n for r in rows} == {3 * (68 - 31)}
    reads = rows[0]
    assert reads.mae < reads.mean_mae / 4 and reads.mae < reads.trend_mae


def test_unscale_is_the_inverse_of_scale(split):
    rows = ft.feature_rows(split, "reads")
    scaler = ft.fit_scaler(rows, ["f_reads_1h", "f_trend_6h"], 12)
    back = ft.unscale(ft.scale(rows, scaler, ["f_reads_1h", "f_trend_6h"]), scaler, {"f_reads_1h": "f_reads_1h", "f_trend_6h": "f_trend_6h"})
    off = back.alias("a").join(rows.alias("b"), ["dataset_id", "timestamp"]).agg(
        F.max(F.abs(F.col("a.f_reads_1h") - F.col("b.f_reads_1h")) + F.abs(F.col("a.f_trend_6h") - F.col("b.f_trend_6h")))).first()[0]
    assert off < 1e-9
