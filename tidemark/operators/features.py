"""Training table, chronological split, sequence samples and scaling for the load forecasters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.numeric import clamp, or_zero, whole
from ..functions.once import with_columns_once
from ..schemas import ROLLING_HOURS
from .forecast import RECENT, TREND_HIGH, TREND_LOW, forecast_columns, trailing_windows
from .reports import temperature
from .skew import MIN_BLOCK_ROWS, Runs, positions, spread

LOOKBACK = 24
HORIZONS = (8, 12)
ORDER = ["timestamp", "reads_1h", "writes_1h", "bytes_read_1h"]

# The inputs of the two forecasters, in order.
SHARED_TAIL = ("trend_6h", "data_temperature_encoded", "access_freq_24h")
FEATURES = {
    kind: (f"{kind}_1h", "bytes_read_1h", "hour_of_day", "day_of_week")
    + tuple(f"{kind}_{h}h" for h in ROLLING_HOURS) + SHARED_TAIL
    for kind in ("reads", "writes")
}

#: What the joint forecaster predicts, each summed over the horizon.
TARGETS = ("reads_1h", "writes_1h", "bytes_read_1h")


def day() -> Column:
    """Bucket of an hourly row: a dataset has few rows per day."""
    return F.floor(F.col("timestamp") / 86400)


def encode_temperature(name: Column) -> Column:
    return F.when(name == "hot", 2).when(name == "warm", 1).when(name == "cold", 0)


def rolling_columns(runs: Runs) -> Runs:
    """Sums over the last 6 to 96 rows, clipped trend, class and number of active hours in the last 24 rows.

    Each sum is the difference of two running totals, so a row costs the same for every width.
    """
    w = runs.window
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    series = {"reads": F.col("reads_1h"), "writes": F.col("writes_1h"), "active": (F.col("reads_1h") > 0).cast("long")}
    # As decimals: exact, and no value of an event can make a running total overflow.
    exact = lambda c: or_zero(c).cast("decimal(19,0)")
    runs = runs.with_columns(
        run_no=F.row_number().over(w), **{f"run_{k}": F.sum(exact(c)).over(upto) for k, c in series.items()}
    )
    back = lambda k, n: F.coalesce(F.lag(f"run_{k}", n).over(w), F.lit(0).cast("decimal(29,0)"))
    widths = [(k, h) for k in ("reads", "writes") for h in ROLLING_HOURS] + [("active", 24), ("reads", 2 * RECENT)]
    lags = {f"run_{k}_{n}": back(k, n) for k, n in widths}
    runs = runs.with_columns(**lags)
    c = F.col
    out = {f"{k}_{h}h": (c(f"run_{k}") - c(f"run_{k}_{h}")).cast("double") for k in ("reads", "writes") for h in ROLLING_HOURS}
    recent = (c("run_reads") - c(f"run_reads_{RECENT}")).cast("double") / F.least(c("run_no"), F.lit(RECENT))
    rows_before = F.least(c("run_no") - RECENT, F.lit(RECENT))
    before = F.when(
        rows_before > 0, (c(f"run_reads_{RECENT}") - c(f"run_reads_{2 * RECENT}")).cast("double") / rows_before
    ).otherwise(F.lit(0.0))
    out["trend_6h"] = clamp(recent / F.greatest(before, F.lit(1.0)), TREND_LOW, TREND_HIGH)
    out["access_freq_24h"] = (c("run_active") - c("run_active_24")).cast("double")
    out["data_temperature"] = temperature((c("run_reads") - c("run_reads_24")).cast("double"))
    kept = [n for n in runs.df.columns if n in (runs.own, runs.block) or not n.startswith("run_")]
    return replace(runs, df=runs.df.select(*kept, *[v.alias(n) for n, v in out.items()]))


def training_table(access: DataFrame, min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """Hourly access rows with the rolling features."""
    base = access.select("dataset_id", "timestamp", "reads_1h", "writes_1h", "bytes_read_1h", "hour_of_day", "day_of_week")
    runs = spread(base, "dataset_id", ORDER, day(), lookback=max(ROLLING_HOURS) - 1, min_rows=min_rows)
    return rolling_columns(runs).done()


def chronological_split(table: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Adds ``is_train`` (the first ``fraction`` of the rows of each dataset), the position ``part_pos`` within its
    part and the number of rows ``part_rows`` of that part."""
    placed = positions(table, "dataset_id", ORDER, day())
    n_train = F.floor(F.col("key_rows") * fraction)
    train = F.col("pos") < n_train
    return placed.withColumns({
        "is_train": train,
        "part_pos": F.when(train, F.col("pos")).otherwise(F.col("pos") - n_train),
        "part_rows": F.when(train, n_train).otherwise(F.col("key_rows") - n_train),
    }).drop("pos", "key_rows")


def feature_rows(table: DataFrame, kind: str) -> DataFrame:
    """The twelve inputs of a forecaster as doubles, next to the keys and the target series."""
    encoded = table.withColumn("data_temperature_encoded", encode_temperature(F.col("data_temperature")))
    keep = [c for c in ("is_train", "part_pos", "part_rows") if c in table.columns]
    return encoded.select(
        "dataset_id", "timestamp", *keep, F.col(f"{kind}_1h").cast("double").alias("y"),
        *[F.col(c).cast("double").alias(f"f_{c}") for c in FEATURES[kind]],
    )


def sequence_samples(
    rows: DataFrame, features: list[str], horizon: int, lookback: int = LOOKBACK, series: str = "dataset_id",
    min_rows: int = MIN_BLOCK_ROWS,
) -> DataFrame:
    """``x``: the ``lookback`` rows up to each row, ``target``: the sum of ``y`` over the next ``horizon`` rows.
    Only complete windows are kept."""
    # Every value takes part in the order, so rows with one timestamp have one order too.
    order = ["timestamp", "y", *features]
    runs = spread(rows, series, order, day(), lookback=lookback - 1, lookahead=horizon, min_rows=min_rows)
    w = runs.window
    past, future = w.rowsBetween(-(lookback - 1), 0), w.rowsBetween(1, horizon)
    whole_ = (F.count(F.lit(1)).over(past) == lookback) & (F.count(F.lit(1)).over(future) == horizon)
    out = runs.with_columns(
        full=whole_, target=F.sum("y").over(future), x=F.collect_list(F.array(*features)).over(past),
    ).done()
    keep = [c for c in rows.columns if c not in features and c not in ("y", "part_pos", "part_rows")]
    return out.filter("full").select(*keep, "x", "target")


def joint_samples(
    table: DataFrame, features: list[str], horizon: int, lookback: int = LOOKBACK, depth: int | None = None,
    series: str = "dataset_id", min_rows: int = MIN_BLOCK_ROWS,
) -> DataFrame:
    """Samples of several targets at once. ``x``: the features of the newest ``depth`` of ``lookback`` rows, oldest first, in one
    array; ``y``: reads, writes and bytes of the next ``horizon`` rows; ``trend``: the clipped-trend forecast of the three.
    Only complete windows are kept."""
    encoded = {"data_temperature_encoded": encode_temperature(F.col("data_temperature"))} if "data_temperature" in table.columns else {}
    runs = spread(table.withColumns(encoded), series, ORDER, day(), lookback=lookback - 1, lookahead=horizon, min_rows=min_rows)
    w = runs.window
    future, depth = w.rowsBetween(1, horizon), depth or lookback
    whole_ = (F.row_number().over(w) >= lookback) & F.lead(F.lit(1), horizon).over(w).isNotNull()
    newest = F.array(*[F.col(c).cast("double") for c in features])
    walked = trailing_windows(runs, hours=horizon).with_columns(
        full=whole_, x=newest if depth == 1 else F.flatten(F.collect_list(newest).over(w.rowsBetween(1 - depth, 0))),
        y=F.array(*[F.sum(F.col(c).cast("double")).over(future) for c in TARGETS]),
        last_bytes=F.sum(F.col("bytes_read_1h").cast("double")).over(w.rowsBetween(1 - horizon, 0)),
    ).done()
    trend = F.array("fc_reads", "fc_writes", "last_bytes").alias("trend")
    keep = [c for c in ("dataset_id", "timestamp", "is_train") if c in table.columns]
    return walked.filter("full").withColumns(forecast_columns(horizon)).select(*keep, "x", "y", trend)


def sample_weight(horizon: int, lookback: int = LOOKBACK) -> Column:
    """Number of sequences of its part that contain a row; follows from the row's position alone."""
    sequences = F.col("part_rows") - lookback - horizon + 1
    last = F.least(F.col("part_pos"), sequences - 1)
    first = F.greatest(F.lit(0), F.col("part_pos") - lookback + 1)
    return F.greatest(F.lit(0), last - first + 1)


def fit_scaler(rows: DataFrame, features: list[str], horizon: int, lookback: int = LOOKBACK) -> DataFrame:
    """Mean and population deviation of each feature over all rows of all training sequences, in one row
    ``(mean_*, sd_*)``. Rows are weighted by their number of sequences, so no sequence is built for it."""
    w = F.when(F.col("is_train"), sample_weight(horizon, lookback)).otherwise(F.lit(0)).cast("double")
    weighted = rows.withColumn("w", w).filter("w > 0")
    total = F.sum("w")
    first = weighted.agg(
        *[(F.sum(F.col("w") * F.col(c)) / total).alias(f"mean_{c}") for c in features],
        *[(F.min(c) == F.max(c)).alias(f"same_{c}") for c in features],
    )
    # A second pass over the differences from the mean: squares of large values would cancel. A constant feature keeps
    # its scale.
    m = lambda n: F.col(f"m.{n}")
    centred = with_columns_once(weighted, {"m": first.select(F.struct("*")).scalar()})
    return centred.agg(
        *[F.any_value(m(f"mean_{c}")).alias(f"mean_{c}") for c in features],
        *[
            F.when(F.any_value(m(f"same_{c}")), F.lit(1.0))
            .otherwise(F.sqrt(F.sum(F.col("w") * (F.col(c) - m(f"mean_{c}")) * (F.col(c) - m(f"mean_{c}"))) / total))
            .alias(f"sd_{c}")
            for c in features
        ],
    )


def fit_plain_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same for unweighted columns, such as the target."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.when(F.min(c) == F.max(c), F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"sd_{c}") for c in columns],
    )


def scale(df: DataFrame, scaler: DataFrame, columns: list[str]) -> DataFrame:
    s = with_columns_once(df, {"scaler": scaler.select(F.struct("*")).scalar()})
    return s.withColumns({
        c: (F.col(c) - F.col(f"scaler.mean_{c}")) / F.col(f"scaler.sd_{c}") for c in columns
    }).drop("scaler")


def unscale(df: DataFrame, scaler: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Inverse: ``columns`` maps a scaled column to the column whose scale it has."""
    s = with_columns_once(df, {"scaler": scaler.select(F.struct("*")).scalar()})
    return s.withColumns({
        c: F.col(c) * F.col(f"scaler.sd_{of}") + F.col(f"scaler.mean_{of}") for c, of in columns.items()
    }).drop("scaler")


def backtest(access: DataFrame, horizon: int, lookback: int = LOOKBACK, min_rows: int = MIN_BLOCK_ROWS) -> DataFrame:
    """Clipped-trend forecast after every row with a full window, next to what the next ``horizon`` rows brought."""
    base = access.select("dataset_id", "timestamp", "reads_1h", "writes_1h", "bytes_read_1h")
    runs = spread(base, "dataset_id", ORDER, day(), lookback=max(lookback, horizon) - 1, lookahead=horizon,
                  min_rows=min_rows)
    w = runs.window
    past, future = w.rowsBetween(-(lookback - 1), 0), w.rowsBetween(1, horizon)
    walked = trailing_windows(runs, hours=horizon).with_columns(
        seen=F.count(F.lit(1)).over(past), ahead=F.count(F.lit(1)).over(future),
        actual_reads=whole(F.sum(F.col("reads_1h").cast("double")).over(future)),
        actual_writes=whole(F.sum(F.col("writes_1h").cast("double")).over(future)),
    ).done()
    full = walked.filter((F.col("seen") == lookback) & (F.col("ahead") == horizon))
    return full.withColumns(forecast_columns(horizon)).select(
        "dataset_id", "timestamp", "actual_reads", F.col("fc_reads").alias("predicted_reads"), "actual_writes",
        F.col("fc_writes").alias("predicted_writes"),
    )
