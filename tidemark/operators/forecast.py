"""Access statistics and the clipped-trend forecast, over a stored history or over a running one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import entries as en
from ..functions.numeric import clamp, or_zero, whole
from ..functions.once import with_columns_once
from .skew import Runs

HOURS = 24
RECENT = 6
TREND_LOW, TREND_HIGH = 0.7, 2.0


def _project(recent: Column, older: Column, hours: int) -> Column:
    trend = clamp(recent / F.greatest(older, F.lit(1.0)), TREND_LOW, TREND_HIGH)
    return recent * trend * F.lit(float(hours))


def forecast_columns(hours: int = HOURS) -> dict[str, Column]:
    """Forecast from the columns ``recent_*``, ``older_*`` and ``sum_bytes``; zeros where the history is empty."""
    empty = F.col("n") == 0
    out = {
        f"fc_{k}": F.when(empty, F.lit(0.0)).otherwise(_project(F.col(f"recent_{k}"), F.col(f"older_{k}"), hours))
        for k in ("reads", "writes")
    }
    out["fc_bytes"] = F.col("sum_bytes")
    return out


def window_columns(hours: int = HOURS) -> dict[str, Column]:
    """Statistics of the last ``hours`` history entries, row-local over the array column ``history``."""
    h = F.col("recent_history")
    n = F.size(h)
    head = F.greatest(F.lit(1), F.floor(n / 2).cast("int"))
    recent = en.newest(h, RECENT)
    # The six entries before the recent six, or the older half when there are fewer than twelve.
    older = F.when(n >= 2 * RECENT, F.slice(h, F.greatest(n - 2 * RECENT, F.lit(0)) + 1, F.lit(RECENT))).otherwise(
        F.slice(h, F.lit(1), head)
    )
    safe_mean = lambda a, f: F.when(F.size(a) > 0, en.mean(a, f)).otherwise(F.lit(0.0))
    return {
        "n": n,
        "recent_reads": safe_mean(recent, "reads_1h"),
        "older_reads": safe_mean(older, "reads_1h"),
        "recent_writes": safe_mean(recent, "writes_1h"),
        "older_writes": safe_mean(older, "writes_1h"),
        "sum_reads": en.total(h, "reads_1h"),
        "sum_writes": en.total(h, "writes_1h"),
        "sum_bytes": en.total(h, "bytes_read_1h"),
        "peak_reads": F.coalesce(en.peak(h, "reads_1h"), F.lit(0)),
    }


def with_windows(datasets: DataFrame, hours: int = HOURS) -> DataFrame:
    """Adds the window statistics, averages and forecast to every dataset row; no shuffle."""
    cut = datasets.withColumn("recent_history", en.newest(en.known(F.col("history")), hours))
    return add_averages(with_columns_once(cut, window_columns(hours)).drop("recent_history"), hours)


def add_averages(stats: DataFrame, hours: int = HOURS) -> DataFrame:
    full = F.col("n") > 0
    return stats.withColumns({
        "avg_reads": F.when(full, F.col("sum_reads") / F.col("n")).otherwise(F.lit(0.0)),
        "avg_writes": F.when(full, F.col("sum_writes") / F.col("n")).otherwise(F.lit(0.0)),
        **forecast_columns(hours),
    })


def forecast_access(datasets: DataFrame, hours: int = HOURS) -> DataFrame:
    return with_windows(datasets, hours).select(
        "dataset_id", F.col("fc_reads").alias("reads"), F.col("fc_writes").alias("writes"),
        F.col("fc_bytes").alias("bytes_read"),
    )


def access_stats(datasets: DataFrame) -> DataFrame:
    return with_windows(datasets).select("dataset_id", "n", "avg_reads", "peak_reads", "avg_writes")


def trailing_windows(runs: Runs, hours: int = HOURS) -> Runs:
    """The same statistics for the history as it stood after each row: frames over the last ``hours`` rows."""
    w = runs.window
    last = w.rowsBetween(-(hours - 1), 0)
    recent = w.rowsBetween(-(min(RECENT, hours) - 1), 0)
    before = w.rowsBetween(-(2 * RECENT - 1), -RECENT)
    most = min(2 * RECENT - 1, hours)
    reads, writes, size = or_zero(F.col("reads_1h")), or_zero(F.col("writes_1h")), or_zero(F.col("bytes_read_1h"))
    out = runs.with_columns(
        n=F.least(F.row_number().over(w), F.lit(hours)).cast("long"),
        # In double, as in the row-local form: no value of an event can make it overflow.
        sum_reads=whole(F.sum(reads.cast("double")).over(last)),
        sum_writes=whole(F.sum(writes.cast("double")).over(last)),
        sum_bytes=whole(F.sum(size.cast("double")).over(last)),
        peak_reads=F.max(reads).over(last),
        recent_reads=F.avg(reads).over(recent),
        recent_writes=F.avg(writes).over(recent),
        before_reads=F.avg(reads).over(before),
        before_writes=F.avg(writes).over(before),
        # Below twelve rows the older half lies within so many rows back; rows before the first count as zero.
        **{f"back_{k}_{i}": F.lag(v.cast("double"), i, 0.0).over(w) for k, v in (("reads", reads), ("writes", writes)) for i in range(1, most)},
    )
    n = F.col("n")
    out = out.with_columns(
        half=F.greatest(F.lit(1), F.floor(n / 2).cast("int")), back_reads_0=reads.cast("double"), back_writes_0=writes.cast("double")
    )

    def older(k: str) -> Column:
        # The first half of the window, its oldest row first.
        total = F.lit(0.0)
        for i in reversed(range(most)):
            total = total + F.when(n - F.col("half") <= i, F.col(f"back_{k}_{i}")).otherwise(F.lit(0.0))
        return F.when(n >= 2 * RECENT, F.col(f"before_{k}")).otherwise(total / F.col("half"))

    return out.with_columns(older_reads=older("reads"), older_writes=older("writes"))
