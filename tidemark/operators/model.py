"""Load forecasters trained by Spark on the scaled sequence samples.

``prepare`` writes the samples to the shared folder and ``train`` fits on them, so both run Spark jobs when
called. The samples stay distributed: the fit sums gradients in the executors and only coefficients reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.files import staged
from . import features as ft, linear
from .metrics import forecast_errors

#: Inputs of the joint forecaster: those of the two single ones, each once.
JOINT_FEATURES = tuple(dict.fromkeys(ft.FEATURES["reads"] + ft.FEATURES["writes"]))


@dataclass(frozen=True)
class Samples:
    """Scaled training and validation samples of one target and horizon, and the scaler of the target."""

    kind: str
    horizon: int
    data: DataFrame
    target_scaler: DataFrame


def prepare(split_table: DataFrame, kind: str, horizon: int, lookback: int = ft.LOOKBACK) -> Samples:
    """Features, scaling on the training part, and sequences that do not cross the split."""
    rows = ft.feature_rows(split_table, kind)
    features = [c for c in rows.columns if c.startswith("f_")]
    scaled = ft.scale(rows, ft.fit_scaler(rows, features, horizon, lookback), features)
    series = scaled.withColumn("series", F.concat_ws("|", "dataset_id", "is_train"))
    samples = ft.sequence_samples(series, features, horizon, lookback, series="series").drop("series")
    # The scaler, the fit and the evaluation all read the samples.
    samples = staged(samples.withColumn("x", F.flatten("x")))
    target_scaler = ft.fit_plain_scaler(samples.filter("is_train"), ["target"])
    return Samples(kind, horizon, samples, target_scaler)


def train(samples: Samples, loss: str = "squaredError", max_iter: int = 40, reg: float = 0.01) -> LinearRegressionModel:
    """Linear model on the flattened window; ``loss`` is ``squaredError`` or ``huber``."""
    data = ft.scale(samples.data.filter("is_train"), samples.target_scaler, ["target"])
    vectors = data.select(array_to_vector("x").alias("features"), "target")
    return LinearRegression(
        featuresCol="features", labelCol="target", loss=loss, maxIter=max_iter, regParam=reg, standardization=False,
        solver="l-bfgs",
    ).fit(vectors)


def predict(model: LinearRegressionModel, samples: Samples, validation_only: bool = True) -> DataFrame:
    """Predictions on the original scale: ``dataset_id, timestamp, is_train, target, prediction``."""
    data = samples.data.filter("not is_train") if validation_only else samples.data
    scored = model.transform(data.withColumn("features", array_to_vector("x")))
    plain = ft.unscale(scored, samples.target_scaler, {"prediction": "target"})
    return plain.select("dataset_id", "timestamp", "is_train", "target", "prediction")


def evaluate(predictions: DataFrame, name: str, kind: str, ord_: int) -> DataFrame:
    errors = forecast_errors(predictions, "target", "prediction")
    return errors.select(
        F.lit(kind).alias("target"), F.lit(name).alias("name"), F.lit(ord_).alias("ord"), "n",
        F.col("mae").alias("val_mae"), F.col("rmse").alias("val_rmse"), F.col("mape").alias("val_mape"),
    )


def standardised(samples: DataFrame, scale: list[tuple[float, float]], name: str) -> Column:
    """An array column of ``samples`` with each place on the scale of its (mean, deviation)."""
    if len(scale) <= linear.SHORT:
        return F.array(*[(F.get(name, F.lit(i)) - F.lit(m)) / F.lit(s) for i, (m, s) in enumerate(scale)])
    mean, sd = (", ".join(f"{v!r}D" for v in column) for column in zip(*scale))
    return F.expr(f"zip_with(zip_with({name}, array({mean}), (v, m) -> v - m), array({sd}), (v, s) -> v / s)")


def array_scale(rows: DataFrame, name: str, size: int) -> list[tuple[float, float]]:
    """Mean and population deviation of each place of an array column; a constant place keeps its scale. One row of
    ``3 * size`` numbers comes back."""
    at = [F.get(name, F.lit(i)) for i in range(size)]
    out = rows.agg(*[f(c) for c in at for f in (F.avg, F.stddev_pop)], *[F.min(c) == F.max(c) for c in at]).first()
    return [
        (out[2 * i] or 0.0, 1.0 if out[2 * size + i] is not False or not out[2 * i + 1] else out[2 * i + 1]) for i in range(size)
    ]


def staged_places(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``staged``, with the short ones of the array columns of known sizes written place by place, as plain columns are read faster."""
    short = {n: [f"{n}_{i}" for i in range(size)] for n, size in sizes.items() if size <= linear.SHORT}
    others = [c for c in df.columns if c not in short]
    kept = staged(df.select(*others, *[F.get(n, F.lit(i)).alias(p) for n, places in short.items() for i, p in enumerate(places)]))
    return kept.select(*others, *[F.array(*places).alias(n) for n, places in short.items()])


def joint_forecast(
    split_table: DataFrame, horizon: int, features: tuple[str, ...] = JOINT_FEATURES, depth: int = ft.LOOKBACK,
    losses: tuple[str, ...] = ("squaredError", "huber"), reg: float = 0.01,
) -> DataFrame:
    """One model for reads, writes and bytes of the next ``horizon`` hours, fitted on the training part and judged on the other.

    A row per loss and target: ``target, name, loss, n`` (samples judged), ``mae``, and the errors of always predicting the
    training mean (``mean_mae``) and of the clipped-trend forecast (``trend_mae``), all in the unit of the target.
    """
    series = split_table.withColumn("series", F.concat_ws("|", "dataset_id", "is_train"))
    d, k = len(features) * depth, len(ft.TARGETS)
    made = ft.joint_samples(series, list(features), horizon, depth=depth, series="series")
    samples = staged_places(made.select("is_train", "x", "y", "trend"), {"x": d, "y": k, "trend": k})
    known = samples.filter("is_train")
    scale_x, scale_y = array_scale(known, "x", d), array_scale(known, "y", k)
    plain = samples.select("is_train", standardised(samples, scale_x, "x").alias("x"), standardised(samples, scale_y, "y").alias("y"), F.col("y").alias("truth"), "trend")
    # Scaling short arrays again for each reading costs less than another copy.
    scaled = plain if d <= linear.SHORT else staged(plain)
    train_rows, judged = scaled.filter("is_train").select("x", "y"), scaled.filter("not is_train")
    fits = {loss: linear.fit(train_rows, d, k, loss, reg) for loss in losses}
    truth = [F.get("truth", F.lit(t)) for t in range(k)]
    off = lambda t, guess: F.avg(F.abs(truth[t] - guess))
    # All errors in one reading: a row with a column per error, then a row per loss and target.
    errors = judged.agg(
        F.count("*").alias("n"),
        *[off(t, fits[loss].predict(t) * sd + mean).alias(f"mae_{i}_{t}") for i, loss in enumerate(losses) for t, (mean, sd) in enumerate(scale_y)],
        *[off(t, F.lit(mean)).alias(f"mean_mae_{t}") for t, (mean, _) in enumerate(scale_y)],
        *[off(t, F.get("trend", F.lit(t))).alias(f"trend_mae_{t}") for t in range(k)],
    )
    return errors.select(F.inline(F.array(*[
        F.struct(
            F.lit(target.removesuffix("_1h")).alias("target"), F.lit(f"{horizon}h").alias("name"), F.lit(loss).alias("loss"), "n",
            F.col(f"mae_{i}_{t}").alias("mae"), F.col(f"mean_mae_{t}").alias("mean_mae"), F.col(f"trend_mae_{t}").alias("trend_mae"),
        )
        for i, loss in enumerate(losses) for t, target in enumerate(ft.TARGETS)
    ])))


def compare(split_table: DataFrame, horizons=ft.HORIZONS, kinds=("reads", "writes"), loss: str = "squaredError",
            max_iter: int = 40) -> DataFrame:
    """Train every target and horizon and return their validation errors, one row each."""
    out = None
    for kind in kinds:
        for i, horizon in enumerate(horizons):
            s = prepare(split_table, kind, horizon)
            row = evaluate(predict(train(s, loss, max_iter), s), f"{horizon}h", kind, i)
            out = row if out is None else out.unionByName(row)
    return out
