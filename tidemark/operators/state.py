"""Dataset state: one row per dataset with its newest 24 hourly entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import HISTORY_LENGTH
from ..functions.entries import in_time, known, newest
from ..schemas import DATASET, HISTORY_FIELDS

LAST_FIELDS = ("size_gb", "reads_1h", "writes_1h", "bytes_read_1h")


def history_entry() -> Column:
    return F.struct(*HISTORY_FIELDS)


#: Orders of a dataset's events. By event time, events of one time are in the order of their arrival.
ORDERS = {"arrival": ("seq",), "event_time": ("timestamp", "seq")}


def last_entries(events: DataFrame, n: int = HISTORY_LENGTH, order_by: str = "arrival") -> DataFrame:
    """Newest ``n`` events per dataset. Spark limits each group before the shuffle too, so a hot dataset sends at most
    ``n`` rows per input task."""
    newest_first = W.partitionBy("dataset_id").orderBy(*[F.desc(c) for c in ORDERS[order_by]])
    return events.withColumn("rn", F.row_number().over(newest_first)).filter(F.col("rn") <= n)


def first_values(events: DataFrame) -> DataFrame:
    """Tiers of the event of each dataset that arrived first, the highest reads, number and span of its events in a batch."""
    return events.groupBy("dataset_id").agg(
        F.min_by(F.struct("current_backend", "initial_backend"), "seq").alias("born"), F.max("reads_1h").alias("top"),
        F.count("*").alias("rows"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
    )


def summarise(events: DataFrame, order_by: str = "arrival") -> DataFrame:
    """One row per dataset of a batch of valid events: newest entries and values, and the tiers of the event that arrived
    first.

    Every event stands in two runs, one from the newest on and one from the first arrival on. Both are cut before the shuffle,
    so the events are read once and a hot dataset sends few rows per input task.
    """
    by = [F.col(c) for c in ORDERS[order_by]]
    places = F.array(
        F.struct(F.lit(True).alias("late"), *[F.bitwise_not(c).alias(f"by{i}") for i, c in enumerate(by)]),
        F.struct(F.lit(False).alias("late"), *[(F.col("seq") if i == 0 else F.lit(0).cast("long")).alias(f"by{i}") for i in range(len(by))]),
    )
    runs = events.select("*", F.inline(places))
    order = [f"by{i}" for i in range(len(by))]
    kept = runs.withColumn("rn", F.row_number().over(W.partitionBy("dataset_id", "late").orderBy(*order))).filter(
        F.col("rn") <= HISTORY_LENGTH
    )
    late = F.col("late")
    row = kept.groupBy("dataset_id").agg(
        F.sort_array(F.collect_list(F.when(late, F.struct((-F.col("rn")).alias("back"), history_entry().alias("entry"))))).alias("tail"),
        F.min_by(F.struct("size_gb"), F.when(late, F.col("rn"))).alias("last"),
        F.min_by(F.struct("current_backend", "initial_backend"), F.when(~late, F.col("rn"))).alias("born"),
    )
    newest_entry = F.get("history", F.size("history") - 1)
    return row.withColumn("history", F.transform("tail", lambda e: e["entry"])).select(
        "dataset_id", "last.size_gb", "born.initial_backend", "born.current_backend", newest_entry["timestamp"].alias("last_timestamp"),
        *[newest_entry[f].alias(f) for f in LAST_FIELDS[1:]], F.lit(None).cast("double").alias("last_migrated_at"), "history",
    )


def fold_events(events: DataFrame, order_by: str = "arrival") -> DataFrame:
    """State built from events alone."""
    return summarise(events, order_by).select(*DATASET.names)


def upsert(state: DataFrame, batch: DataFrame, touched_only: bool = False, order_by: str = "arrival") -> DataFrame:
    """Merge a summarised batch into the state; with ``touched_only`` just the rows the batch changes. Tiers and the time of
    the last move belong to the state, so a late event undoes no move; histories are joined and cut to 24 entries. By arrival
    the newest values come from the batch. By event time entries are merged by their time, and the newest values are those of
    the newest entry; of entries of one time the one that arrived later is the newer. The result is that of all events
    folded at once, however late they come, because a batch brings its own newest 24."""
    old, new = state.alias("old"), batch.alias("new")
    insert_only = {"initial_backend", "current_backend", "last_migrated_at"}
    is_new = F.col("old.dataset_id").isNull()
    by_time = order_by == "event_time"
    stays = F.col("new.dataset_id").isNull()
    if by_time:
        stays = stays | F.coalesce(F.col("old.last_timestamp") > F.col("new.last_timestamp"), F.lit(False))
    columns = [F.coalesce("old.dataset_id", "new.dataset_id").alias("dataset_id")]
    for name in DATASET.names[1:]:
        o, n = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name == "history":
            both = F.concat(known(o), known(n))
            merged = newest(in_time(both) if by_time else both, HISTORY_LENGTH)
        elif name in insert_only:
            merged = F.when(is_new, n).otherwise(o)
        else:
            merged = F.when(stays, o).otherwise(n)
        columns.append(merged.alias(name))
    how = "right" if touched_only else "full"
    return old.join(new, F.col("old.dataset_id") == F.col("new.dataset_id"), how).select(*columns)


def explode_history(datasets: DataFrame) -> DataFrame:
    """One row per history entry, oldest first by ``pos``."""
    return datasets.select("dataset_id", F.posexplode("history").alias("pos", "e")).select(
        "dataset_id", "pos", *[F.col(f"e.{f}").alias(f) for f in HISTORY_FIELDS]
    )


def duplicate_keys(df: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def with_history(datasets: DataFrame) -> DataFrame:
    return datasets.filter(F.size("history") > 0)


def dataset_detail(datasets: DataFrame, dataset_id: str) -> DataFrame:
    """The row of one dataset; empty when there is none."""
    return datasets.filter(F.col("dataset_id") == dataset_id).limit(1)
