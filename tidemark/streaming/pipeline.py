"""Event stream -> dead letters, dataset state and jobs; request stream -> scans; rate stream."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import LIMITS, Limits
from ..operators.ingest import ingest_batch
from ..operators.jobs import finish_request, next_request, scan
from ..operators.metrics import event_rate
from ..operators.validate import dead_letters, validate_events
from ..schemas import DATASET, JOB, REQUEST, RUN_LOG
from ..sources.files import ARRIVAL, is_complete, materialise
from ..sources.keyed_table import KeyedTable


class Store:
    """The tables of one deployment under a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        # The event and the scan stream of one application both write jobs; they take turns.
        self.lock = threading.RLock()
        self.state = KeyedTable(spark, f"{root}/state", "dataset_id", DATASET)
        # Pending jobs are what a batch has to know of the jobs; all others are kept apart from them.
        self.jobs = KeyedTable(spark, f"{root}/jobs", "job_id", JOB, apart="status = 'PENDING'")
        self.requests = KeyedTable(spark, f"{root}/requests", "request_id", REQUEST, apart="status = 'PENDING'")

    def batch_path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def run_log(self) -> DataFrame:
        """One row per batch: how many events came, how many were accepted, how long it took."""
        return self.spark.read.parquet(f"{self.root}/runs")

    def dead_letters(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/dead_letters").drop("batch")


def number_arrivals(store: Store, df: DataFrame, batch: int) -> DataFrame:
    """Store a file batch in arrival order with its arrival numbers. The written copy is what the batch works on, so
    the numbers stay the same when a task is run again."""
    path = store.batch_path("inbox", batch)
    if not is_complete(store.spark, path):
        # Rows of a block are numbered in their order, unless they come with one; blocks of a file may be read in any.
        lined = df if "line" in df.columns else df.withColumn("line", F.monotonically_increasing_id())
        ordered = lined.orderBy(*ARRIVAL, "line")
        ordered.select("value", F.monotonically_increasing_id().alias("seq")).write.mode("overwrite").parquet(path)
    return store.spark.read.schema("value string, seq long").parquet(path)


def log_batch(store: Store, batch: int, now: float, service: str, counts: dict, seconds: float) -> None:
    """The counters of a batch as one row of the run log, in a folder of the batch: a batch that is repeated replaces it."""
    events, accepted_ = float(counts["events"]), float(counts["accepted"])
    rate = accepted_ / seconds if seconds > 0 else 0.0
    row = (service, float(now), events, accepted_, float(seconds), rate, rate * 3600, None)
    store.spark.createDataFrame([row], RUN_LOG).write.mode("overwrite").parquet(store.batch_path("runs", batch))


def process_batch(
    store: Store, raw: DataFrame, batch: int, now: float, limits: Limits = LIMITS, skip_noop: bool = False,
    name: str = "ingest", order_by: str = "arrival",
) -> bool:
    """Run one batch and write its results: dead letters, new jobs, then the state, whose folder commits the batch.
    A batch that is already committed is left alone."""
    with store.lock:
        return _process_batch(store, raw, batch, now, limits, skip_noop, name, order_by)


def _process_batch(store, raw, batch, now, limits, skip_noop, name, order_by) -> bool:
    tag = f"{name}-{batch}"
    if store.state.has(tag):
        return False
    began = time.time()
    if "seq" not in raw.columns:
        raw = number_arrivals(store, raw, batch)
    # Every branch of the batch reads the validated rows; a lost copy is computed again from the source.
    validated = validate_events(raw.select("value", "seq")).persist(StorageLevel.DISK_ONLY)
    try:
        out = ingest_batch(validated, store.state.read(), store.jobs.read_apart(), now, limits, skip_noop, order_by=order_by)
        seen = Observation()
        counted = validated.observe(seen, F.count(F.lit(1)).alias("events"), F.count_if("valid").alias("accepted"))
        dead_letters(counted, now).write.mode("overwrite").parquet(store.batch_path("dead_letters", batch))
        store.jobs.write(out.jobs, tag)
        log_batch(store, batch, now, name, seen.get, time.time() - began)
        store.state.write(out.state, tag)
    finally:
        validated.unpersist()
    return True


def ingest_stream(
    source: DataFrame, store: Store, checkpoint: str, clock: Callable[[], float] = time.time, limits: Limits = LIMITS,
    skip_noop: bool = False, trigger: dict | None = None, order_by: str = "arrival", replays: str | None = None,
) -> StreamingQuery:
    """Start the event pipeline. ``trigger`` goes to ``DataStreamWriter.trigger``, for example
    ``{"availableNow": True}``. With ``replays``, a span such as ``2 hours``, events that arrive again within it are dropped
    before the fold; lines are then taken in the order of their event times within a block."""
    if replays:
        source = without_replays(source, replays)

    def each(df: DataFrame, batch: int) -> None:
        process_batch(store, df, batch, clock(), limits, skip_noop, order_by=order_by)

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def run_scan(store: Store, now: float, tag: str, limits: Limits = LIMITS) -> DataFrame:
    """Claim the oldest pending request, if any, scan all datasets and write the new jobs. Returns the jobs made. The
    same tag again finds what the first run wrote and adds nothing."""
    with store.lock:
        return _run_scan(store, now, tag, limits)


def _run_scan(store: Store, now: float, tag: str, limits: Limits) -> DataFrame:
    # The claimed row and the jobs have files of their own under the tag, so a repeat goes on with the same ones.
    folder = f"{store.root}/scans/{tag}"
    pending = store.requests.read_apart()
    claimed = materialise(next_request(pending).withColumns({"status": F.lit("RUNNING"), "started_at": F.lit(float(now))}), f"{folder}/request")
    store.requests.write(claimed, f"{tag}-claim")
    made = materialise(scan(store.state.read(), store.jobs.read_apart(), now, limits), f"{folder}/jobs")
    store.jobs.write(made, tag)
    mine = [r.request_id for r in claimed.select("request_id").collect()]  # one at most
    if mine:
        done = finish_request(claimed, mine[0], now, made.agg(F.count("*")).scalar())
        store.requests.write(done, f"{tag}-finish")
    return made


def run_pending_scans(store: Store, now: float, tag: str, limits: Limits = LIMITS) -> int:
    """One scan for each pending request, oldest first, and one scan when there is none. Returns the number of scans."""
    done = 0
    while True:
        waiting = not next_request(store.requests.read_apart()).isEmpty()
        if done and not waiting:
            return done
        run_scan(store, now, f"{tag}-{done}", limits)
        done += 1


def scan_stream(
    ticks: DataFrame, store: Store, checkpoint: str, clock: Callable[[], float] = time.time, limits: Limits = LIMITS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Scan whenever ``ticks`` (any stream, such as new requests) has data, at most once per trigger interval."""

    def each(df: DataFrame, batch: int) -> None:
        run_pending_scans(store, clock(), f"scan-{batch}", limits)

    writer = ticks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def rate_stream(events: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Events per second and minute of a stream; windows close ``late`` after their end."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return event_rate(timed, ts)


def write_rates(events: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Append the rate of every window to ``path`` once it is closed."""
    writer = rate_stream(events, late=late).writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start()


def rate_account(spark: SparkSession, path: str, checkpoint: str, came: DataFrame) -> DataFrame:
    """What became of all events that came: ``(part, window_start, events)`` with a row per closed window, one for the events in
    windows still open (from the state of the stream) and one for those that came too late for their window."""
    schema = "window_start timestamp, events long, events_per_sec double"
    closed = spark.read.schema(schema).parquet(path).select(F.lit("closed").alias("part"), "window_start", "events")
    waiting = spark.read.format("statestore").load(checkpoint).agg(F.coalesce(F.sum("value.count"), F.lit(0)).alias("n"))
    total = came.agg(F.count("*").alias("came")).withColumn("open", waiting.select("n").scalar())
    counted = F.coalesce(closed.agg(F.sum("events")).scalar(), F.lit(0))
    rest = total.select(F.inline(F.array(
        F.struct(F.lit("open").alias("part"), F.lit(None).cast("timestamp").alias("window_start"), F.col("open").alias("events")),
        F.struct(F.lit("late").alias("part"), F.lit(None).cast("timestamp").alias("window_start"), (F.col("came") - F.col("open") - counted).alias("events")),
    )))
    return closed.unionByName(rest)


def drop_replays(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Optional: drop events repeated within ``late`` of each other. ``timestamp`` is the epoch of the event."""
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late)
    return timed.dropDuplicatesWithinWatermark(["dataset_id", "timestamp"]).drop("event_time")


def without_replays(source: DataFrame, late: str) -> DataFrame:
    """Event text without the events that have arrived before, by dataset and time. The span is one of arrival: the clock of
    the files drives the watermark, so that no time inside an event can make others late. Text without these two fields goes
    on as it is."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    named = source.withColumns({"replay_of": field("dataset_id"), "line": field("timestamp").try_cast("long")})
    known = F.col("replay_of").isNotNull() & F.col("line").isNotNull()
    timed = named.withWatermark("arrived", late)
    once = timed.filter(known).dropDuplicatesWithinWatermark(["replay_of", "line"])
    return once.unionByName(timed.filter(~known)).drop("replay_of")
