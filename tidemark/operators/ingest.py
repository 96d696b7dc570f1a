"""One batch of raw events against the current state and jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import COLD_TIER, HISTORY_LENGTH, LIMITS, Limits
from ..functions.text import live_reason
from ..sources.files import staged
from .forecast import add_averages, trailing_windows
from .jobs import create_jobs
from .placement import DECISION, decide
from .skew import MIN_BLOCK_ROWS, spread
from .state import ORDERS, explode_history, first_values, summarise, upsert
from .validate import accepted, dead_letters

# A hot dataset is cut into blocks along buckets of arrival numbers: at least this many per bucket, and about this
# many buckets over a whole batch, so that the bucket counts of one dataset stay small too.
MIN_BUCKET, BUCKETS = 64, 4_000_000


@dataclass(frozen=True)
class Ingested:
    """What a batch produces. ``state`` holds only the datasets the batch touched."""

    dead_letters: DataFrame
    state: DataFrame
    triggers: DataFrame
    jobs: DataFrame


def hot_reactions(
    events: DataFrame, state: DataFrame, limits: Limits = LIMITS, skip_noop: bool = False,
    min_rows: int = MIN_BLOCK_ROWS, order_by: str = "arrival",
) -> DataFrame:
    """A decision for every event with many reads on a dataset in cold storage, judged on the state right after that
    event. A decision to stay still counts, unless ``skip_noop``.

    Only datasets that can react are walked. ``seq`` numbers the arrivals from 0, uniquely per dataset. By event time an
    event is judged on the entries up to its own time, out of the batch and the ones kept before it.
    """
    summary = first_values(events).filter(F.col("top") > limits.hot_reads)
    known = state.select(F.col("dataset_id").alias("known_id"), F.col("current_backend").alias("state_tier"), "history")
    tier = F.when(F.col("known_id").isNull(), F.col("born.current_backend")).otherwise(F.col("state_tier"))
    # Datasets that can react, with the history they bring along. Stored: the rest reads them twice, and asks for their sizes.
    ready = staged(
        summary.join(known, F.col("dataset_id") == F.col("known_id"), "left")
        .filter(tier == COLD_TIER)
        .select("dataset_id", "history", "rows", "t0", "t1")
    )
    sizes = ready.agg(F.sum("rows"), F.max("rows"), F.min("t0"), F.max("t1")).first()
    total, largest, t0, t1 = (x or 0 for x in sizes)
    fields = ["dataset_id", "seq", "timestamp", "reads_1h", "writes_1h", "bytes_read_1h", "size_gb"]
    new = events.join(ready.select("dataset_id"), "dataset_id", "left_semi").select(*fields)
    old = explode_history(ready).select(
        "dataset_id", (F.col("pos") - HISTORY_LENGTH).cast("long").alias("seq"), "timestamp", "reads_1h", "writes_1h",
        "bytes_read_1h", F.lit(None).cast("double").alias("size_gb"),
    )
    rows = new.unionByName(old)
    if order_by == "arrival":
        bucket = F.floor(F.col("seq") / max(MIN_BUCKET, -(-total // BUCKETS)))
    else:
        bucket = F.floor(F.col("timestamp") / max(1, -(-(t1 - t0) // BUCKETS)))
    runs = spread(
        rows, "dataset_id", list(ORDERS[order_by]), bucket, lookback=HISTORY_LENGTH - 1, min_rows=min_rows,
        largest=largest + HISTORY_LENGTH,
    )
    walked = trailing_windows(runs, HISTORY_LENGTH).done()
    hot = walked.filter((F.col("seq") >= 0) & (F.col("reads_1h") > limits.hot_reads))
    judged = decide(add_averages(hot).withColumn("current_backend", F.lit(COLD_TIER)), limits)
    if skip_noop:
        judged = judged.filter(F.col("target_backend") != F.col("current_backend"))
    return judged.select("dataset_id", "seq", "timestamp", "reads_1h", "n", "current_backend", *DECISION)


def reaction_jobs(triggers: DataFrame, jobs: DataFrame, now: float) -> DataFrame:
    candidates = triggers.select(
        "dataset_id", F.col("current_backend").alias("from_backend"), F.col("target_backend").alias("to_backend"),
        live_reason(F.col("reason")).alias("reason"), F.col("seq").alias("ord"),
    )
    return create_jobs(candidates, jobs, now)


def ingest_batch(
    validated: DataFrame, state: DataFrame, jobs: DataFrame, now: float, limits: Limits = LIMITS,
    skip_noop: bool = False, min_rows: int = MIN_BLOCK_ROWS, order_by: str = "arrival",
) -> Ingested:
    """``validated`` comes from ``validate_events`` on rows with the event text ``value`` and the arrival number
    ``seq``. Several branches read it, so persist or store it first when it is costly to compute. ``order_by`` is
    ``arrival`` or ``event_time``; the second is for events that may come late, and a deployment keeps to one of them."""
    events = accepted(validated)
    triggers = hot_reactions(events, state, limits, skip_noop, min_rows, order_by)
    new_state = upsert(state, summarise(events, order_by), touched_only=True, order_by=order_by)
    return Ingested(dead_letters(validated, now), new_state, triggers, reaction_jobs(triggers, jobs, now))
