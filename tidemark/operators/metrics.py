"""Forecast errors, losses, rates and run summaries; all are single aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import ratio


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and the error relative to the mean actual value in percent."""
    e = F.col(actual).cast("double") - F.col(predicted)
    out = df.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(F.col(actual))).alias("mean_actual"),
    )
    mape = F.when(F.col("mean_actual") > 0, F.col("mae") / F.col("mean_actual") * 100).otherwise(F.lit(0.0))
    return out.withColumn("mape", mape).drop("mean_actual")


def huber(e: Column, delta: float = 1.0) -> Column:
    size = F.abs(e)
    return F.when(size <= delta, 0.5 * e * e).otherwise(delta * (size - 0.5 * delta))


def losses(df: DataFrame, targets: list[tuple[str, str]], delta: float = 1.0) -> DataFrame:
    """Huber loss, as the sum over the targets of their means, and mean squared error over all target values."""
    errors = [F.col(a).cast("double") - F.col(p) for a, p in targets]
    robust = sum((F.avg(huber(e, delta)) for e in errors[1:]), F.avg(huber(errors[0], delta)))
    square = sum((F.avg(e * e) for e in errors[1:]), F.avg(errors[0] * errors[0])) / len(errors)
    return df.agg(robust.alias("huber"), square.alias("mse"))


def best_model(results: DataFrame) -> DataFrame:
    """The model with the smallest ``val_mae`` of each target; the first in ``ord`` wins ties."""
    best = results.groupBy("target").agg(F.min(F.struct("val_mae", "ord", "name")).alias("b"))
    return best.select("target", F.col("b.name").alias("best"), F.col("b.val_mae").alias("val_mae"))


def event_rate(events: DataFrame, ts: str = "ts", width: str = "1 minute", seconds: float = 60.0) -> DataFrame:
    """Events per second in each window; works on a batch and on a stream."""
    counts = events.groupBy(F.window(F.col(ts), width).alias("w")).agg(F.count("*").alias("events"))
    return counts.select(
        F.col("w.start").alias("window_start"), "events", (F.col("events") / seconds).alias("events_per_sec")
    )


def throughput(validated: DataFrame, duration: Column) -> DataFrame:
    """Events, accepted events and their rate over ``duration`` seconds (an aggregate expression)."""
    counts = validated.agg(
        F.count("*").alias("events"), F.count_if("valid").alias("accepted"), duration.cast("double").alias("duration_sec")
    )
    rate = ratio(F.col("accepted"), F.col("duration_sec"))
    return counts.select(
        "events", "accepted", F.round("duration_sec", 3).alias("duration_sec"),
        F.round(rate, 2).alias("events_per_sec"), F.round(rate * 3600, 2).alias("events_per_hour"),
    )


def run_counters(validated: DataFrame) -> DataFrame:
    """Processed and rejected events, by error for the rejected ones."""
    return validated.groupBy(F.coalesce("error", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("events"))
