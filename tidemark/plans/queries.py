"""Every registered query: ``(spark, folder of parquet tables) -> DataFrame``. Each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Limits
from ..operators import features as ft
from ..operators import forecast, jobs as jb, metrics, model, placement, pricing, reports, scenario, state
from ..operators.ingest import hot_reactions as reactions, ingest_batch
from ..operators.quantiles import RANK_ERROR, exact_quantile, merged_quantiles, quantile_sketches, rank_errors
from ..operators.validate import accepted, dead_letters, validate_events
from ..schemas import DATASET, JOB, REQUEST, ROLLING_HOURS
from ..sources import derived as dv
from ..sources.files import (
    append_request, append_run, keyed_messages, latest_logged_run, read_pipe_log, read_training_csv, reused, run_of,
    run_folder, staged, text_event_stream, write_event_files,
)
from ..streaming.pipeline import Store, ingest_stream, rate_account, scan_stream, write_rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Clock of the job queries; later than every order date.
NOW = 1_100_000_000.0
CLAIM, CLAIM_MANY = 1000, 100_000
# The state query is fed in two batches cut at this hour number (2024-01-16).
CUT_HOUR = 473_712
# Arrival numbers of the late events: a permutation of the hours, as this is a prime, and the number where the second batch begins.
ARRIVALS, LATE_CUT = 100_003, 50_000
STRICT = Limits(hot_reads=400, cold_reads=500)


def query(f: Query) -> Query:
    """Registers a query; the copies it stages lie under one run id of its name."""

    @wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        with run_of(f.__name__):
            return f(spark, sf)

    QUERIES[f.__name__] = run
    return run


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded for comparison; sums of doubles differ in the last bits with the order of rows."""
    return df.select(*[
        F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def _raw(spark, sf):
    return dv.raw_events(dv.access(spark, sf))


def _valid(spark, sf):
    return accepted(validate_events(_raw(spark, sf)))


def _checked(spark, sf):
    return staged(validate_events(_raw(spark, sf)))


def _no_state(spark):
    return spark.createDataFrame([], DATASET)


def _no_jobs(spark):
    return spark.createDataFrame([], JOB)


def _state_row(ds: DataFrame) -> DataFrame:
    """State with its history summed up, so that it compares as plain columns."""
    return ds.select(
        "dataset_id", "size_gb", "initial_backend", "current_backend", "last_timestamp", "reads_1h", "writes_1h",
        "bytes_read_1h", F.size("history").cast("long").alias("entries"),
        F.col("history")[0]["timestamp"].alias("first_timestamp"),
        F.aggregate("history", F.lit(0).cast("long"), lambda a, e: a + e["reads_1h"]).alias("history_reads"),
    )


# ---- events and state ------------------------------------------------------------------------------------


@query
def access_hourly(spark, sf):
    return dv.access(spark, sf).drop("user_id")


@query
def event_validation(spark, sf):
    return validate_events(_raw(spark, sf)).select("seq", "value", "valid", "error")


@query
def accepted_events(spark, sf):
    return _valid(spark, sf)


@query
def dead_letter_events(spark, sf):
    return dead_letters(validate_events(_raw(spark, sf)), NOW)


@query
def run_counters(spark, sf):
    return metrics.run_counters(validate_events(_raw(spark, sf)))


@query
def event_throughput(spark, sf):
    span = F.max("seq") - F.min("seq") + 1
    return metrics.throughput(validate_events(_raw(spark, sf)), span * 3600)


@query
def event_messages(spark, sf):
    """Keyed wire messages of the accepted events."""
    return keyed_messages(_valid(spark, sf).drop("seq", "size_gb"))


@query
def history_entries(spark, sf):
    return state.explode_history(dv.datasets(spark, sf)).withColumn("pos", F.col("pos").cast("long"))


@query
def dataset_state(spark, sf):
    return _state_row(state.fold_events(_valid(spark, sf)))


@query
def dataset_state_upsert(spark, sf):
    """The same state, reached by merging a second batch into the state of a first one."""
    events = accepted(_checked(spark, sf))
    first = state.fold_events(events.filter(F.col("seq") < CUT_HOUR))
    second = state.summarise(events.filter(F.col("seq") >= CUT_HOUR))
    return _state_row(state.upsert(first, second))


@query
def duplicate_dataset_keys(spark, sf):
    return state.duplicate_keys(dv.datasets(spark, sf))


@query
def duplicate_access_keys(spark, sf):
    """Key check of a table whose key does repeat: hourly rows by dataset."""
    return state.duplicate_keys(dv.access(spark, sf))


@query
def dataset_detail(spark, sf):
    return _state_row(state.dataset_detail(dv.datasets(spark, sf), "ds_000007"))


def _late_events(spark, sf):
    """Accepted events that arrive in an order of their own, with times in steps of two hours, so that some coincide."""
    events = accepted(_checked(spark, sf))
    two_hours = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(7200))
    return events.withColumn("timestamp", two_hours).withColumn("seq", F.pmod(F.col("seq") * 7919, F.lit(ARRIVALS)))


@query
def dataset_state_event_time(spark, sf):
    """State by event time, reached in two batches whose rows come in any order."""
    events = staged(_late_events(spark, sf))
    first = state.fold_events(events.filter(F.col("seq") < LATE_CUT), "event_time")
    second = state.summarise(events.filter(F.col("seq") >= LATE_CUT), "event_time")
    return _state_row(state.upsert(first, second, order_by="event_time"))


@query
def hot_reactions_event_time(spark, sf):
    """Reactions of the second of these batches, each event judged on the entries up to its own time."""
    events = staged(_late_events(spark, sf))
    first = staged(state.fold_events(events.filter(F.col("seq") < LATE_CUT), "event_time"))
    out = reactions(events.filter(F.col("seq") >= LATE_CUT), first, order_by="event_time")
    return rounded(out.withColumn("n", F.col("n").cast("long")))


@query
def hot_reactions(spark, sf):
    out = ingest_batch(_checked(spark, sf), _no_state(spark), _no_jobs(spark), NOW)
    return rounded(out.triggers.withColumn("n", F.col("n").cast("long")))


@query
def hot_reactions_on_state(spark, sf):
    """Reactions of the second batch, judged on the state the first one left."""
    checked = _checked(spark, sf)
    first = state.fold_events(accepted(checked.filter(F.col("seq") < CUT_HOUR)))
    out = ingest_batch(checked.filter(F.col("seq") >= CUT_HOUR), first, _no_jobs(spark), NOW)
    return rounded(out.triggers.withColumn("n", F.col("n").cast("long")))


@query
def reaction_job_list(spark, sf):
    out = ingest_batch(_checked(spark, sf), _no_state(spark), _no_jobs(spark), NOW)
    return out.jobs.select("dataset_id", "from_backend", "to_backend", "reason", "status", "attempts", "created_at")


# ---- forecast, prices, placement -------------------------------------------------------------------------


@query
def forecast_access(spark, sf):
    return rounded(forecast.forecast_access(dv.datasets(spark, sf)))


@query
def forecast_access_8h(spark, sf):
    return rounded(forecast.forecast_access(dv.datasets(spark, sf), 8))


@query
def access_stats(spark, sf):
    return rounded(forecast.access_stats(dv.datasets(spark, sf)).withColumn("n", F.col("n").cast("long")))


@query
def tier_costs(spark, sf):
    return rounded(pricing.tier_costs(dv.datasets(spark, sf)))


@query
def window_cost_12h(spark, sf):
    return rounded(pricing.window_cost(dv.datasets(spark, sf), pricing.current_tier(), 12))


@query
def dataset_costs(spark, sf):
    return rounded(pricing.dataset_costs(dv.datasets(spark, sf)))


@query
def baseline_cost(spark, sf):
    return rounded(pricing.baseline_cost(dv.datasets(spark, sf)))


@query
def optimized_cost(spark, sf):
    return rounded(pricing.optimized_cost(dv.datasets(spark, sf), dv.jobs(spark, sf)))


@query
def cost_summary(spark, sf):
    return pricing.cost_summary(dv.datasets(spark, sf), dv.jobs(spark, sf))


@query
def cost_summary_after_faults(spark, sf):
    """Totals over the state built from the faulty event text, which holds unknown tiers."""
    return pricing.cost_summary(state.fold_events(_valid(spark, sf)), dv.jobs(spark, sf))


@query
def savings_after_faults(spark, sf):
    faulty = state.fold_events(_valid(spark, sf))
    # Access costs are whole tenths of a cent, so two places could end on a half.
    return rounded(reports.savings(faulty, dv.jobs(spark, sf), baseline="initial"), 3)


@query
def unpriced_datasets(spark, sf):
    return pricing.unpriced(state.fold_events(_valid(spark, sf)))


@query
def placement_decisions(spark, sf):
    return rounded(placement.evaluate_placement(dv.datasets(spark, sf)))


@query
def placement_other_limits(spark, sf):
    return rounded(placement.evaluate_placement(dv.datasets(spark, sf), STRICT))


@query
def placement_after_faults(spark, sf):
    """Placement of the state built from the faulty event text; unknown tiers are left out."""
    return rounded(placement.evaluate_placement(state.fold_events(_valid(spark, sf))))


@query
def best_backend(spark, sf):
    return placement.choose_best_backend(dv.datasets(spark, sf))


# ---- jobs ------------------------------------------------------------------------------------------------


@query
def scan_jobs(spark, sf):
    made = jb.scan(dv.datasets(spark, sf), dv.jobs(spark, sf), NOW)
    return made.select("dataset_id", "from_backend", "to_backend", "reason", "status", "attempts", "created_at")


@query
def scan_job_count(spark, sf):
    return jb.scan(dv.datasets(spark, sf), dv.jobs(spark, sf), NOW).agg(F.count("*").alias("jobs_created"))


@query
def suppressed_jobs(spark, sf):
    """Ask again for every job there ever was, under a new reason for completed ones; only pairs of dataset and reason
    without a pending job are created."""
    jobs = dv.jobs(spark, sf)
    reason = F.when(F.col("status") == "COMPLETE", F.concat("reason", F.lit(" again"))).otherwise(F.col("reason"))
    asked = jobs.select("dataset_id", "from_backend", "to_backend", reason.alias("reason"), F.col("job_id").alias("ord"))
    made = jb.create_jobs(asked, jobs, NOW)
    return made.select("dataset_id", "from_backend", "to_backend", "reason", "status", "created_at")


@query
def recent_jobs(spark, sf):
    return jb.recent_jobs(dv.jobs(spark, sf)).select("job_id", "dataset_id", "status", "created_at")


@query
def next_jobs(spark, sf):
    return jb.claimed(dv.jobs(spark, sf), NOW, CLAIM).select("job_id", "status", "attempts", "started_at", "created_at")


@query
def claimed_job_table(spark, sf):
    out = jb.claim_jobs(dv.jobs(spark, sf), NOW, CLAIM_MANY)
    return out.select("job_id", "dataset_id", "status", "attempts", "started_at")


@query
def job_outcomes(spark, sf):
    jobs = dv.jobs(spark, sf)
    out = jb.apply_outcomes(jobs, dv.outcomes(jobs), NOW)
    return rounded(out.select(
        "job_id", "status", "attempts", "finished_at", "duration_sec", "error", "retry_after"
    ))


@query
def moved_datasets(spark, sf):
    jobs = dv.jobs(spark, sf).filter(F.col("status") == "COMPLETE")
    moved = jb.apply_moves(dv.datasets(spark, sf), jobs, NOW)
    return moved.select("dataset_id", "initial_backend", "current_backend", "last_migrated_at")


@query
def claimed_requests(spark, sf):
    out = jb.claim_request(dv.requests(spark, sf), NOW)
    return out.select("request_id", "status", "created_at", "started_at")


@query
def finished_requests(spark, sf):
    before = dv.requests(spark, sf)
    mine = jb.next_request(before).select("request_id").scalar()
    made = jb.scan(dv.datasets(spark, sf), dv.jobs(spark, sf), NOW).agg(F.count("*")).scalar()
    out = jb.finish_request(jb.claim_request(before, NOW), mine, NOW + 5, made)
    return out.select("request_id", "status", "started_at", "finished_at", "jobs_created")


# ---- reports ---------------------------------------------------------------------------------------------


@query
def observed_baseline(spark, sf):
    return rounded(reports.observed_baseline(dv.datasets(spark, sf)), 2)


@query
def observed_optimized(spark, sf):
    return rounded(reports.observed_optimized(dv.datasets(spark, sf), dv.jobs(spark, sf)), 2)


@query
def savings_projection(spark, sf):
    return rounded(reports.savings(dv.datasets(spark, sf), dv.jobs(spark, sf)), 2)


@query
def savings_from_initial(spark, sf):
    return rounded(reports.savings(dv.datasets(spark, sf), dv.jobs(spark, sf), baseline="initial"), 2)


@query
def migration_counts(spark, sf):
    return reports.migration_counts(dv.jobs(spark, sf))


@query
def migration_efficiency(spark, sf):
    return rounded(reports.migration_efficiency(dv.jobs(spark, sf)))


@query
def duration_histogram(spark, sf):
    return reports.duration_histogram(dv.jobs(spark, sf))


@query
def p95_duration(spark, sf):
    return rounded(exact_quantile(dv.jobs(spark, sf), "duration_sec", 0.95))


@query
def p95_event_value(spark, sf):
    return rounded(exact_quantile(dv.table(spark, sf, "events"), "value", 0.95))


@query
def tier_distribution(spark, sf):
    return rounded(reports.tier_distribution(dv.datasets(spark, sf)))


@query
def datasets_per_tier(spark, sf):
    return reports.datasets_per_tier(dv.datasets(spark, sf))


@query
def access_patterns(spark, sf):
    return reports.access_patterns(dv.datasets(spark, sf))


@query
def temperature_classes(spark, sf):
    return reports.observed(dv.datasets(spark, sf)).select("dataset_id", "reads", "writes", "temperature")


@query
def job_counts(spark, sf):
    return reports.job_counts(dv.jobs(spark, sf))


@query
def report_totals(spark, sf):
    return reports.totals(dv.datasets(spark, sf), dv.jobs(spark, sf))


@query
def latest_metrics(spark, sf):
    return rounded(reports.latest_metrics(dv.run_log(spark, sf)).drop("ts"))


@query
def overview(spark, sf):
    o = reports.overview(dv.datasets(spark, sf), dv.jobs(spark, sf), dv.run_log(spark, sf), "view")
    tiers = F.aggregate(
        "backend_distribution", F.lit(""),
        lambda a, d: F.concat(a, d["current_backend"], F.lit("="), d["datasets"].cast("string"), F.lit(";")),
    )
    return o.select(
        "total_datasets", tiers.alias("tiers"), "migrations.*", "costs.*", "throughput.*"
    )


@query
def json_report(spark, sf):
    """Key figures of the nested report, read back out of it."""
    r = reports.nested_report(dv.datasets(spark, sf), dv.jobs(spark, sf), "2024-02-01T00:00:00")
    c = F.col
    return rounded(r.select(
        "generated_at", c("system.total_datasets"), c("system.total_migrations"),
        c("costs.baseline.total").alias("baseline"), c("costs.optimized.breakdown.migration"),
        c("costs.savings.annual"), c("migrations.efficiency.success_rate"), c("migrations.efficiency.median_duration"),
        c("migrations.efficiency.by_status")["FAILED"].alias("failed"),
        c("costs.unpriced_datasets"), c("backends")["on-prem"]["count"].alias("on_prem"),
        c("access_patterns.hot_datasets"),
    ), 2)


@query
def report_reasons(spark, sf):
    """The rows of the written report that count jobs by reason."""
    lines = reports.json_report(dv.datasets(spark, sf), dv.jobs(spark, sf), "2024-02-01T00:00:00")
    return lines.filter(F.col("part") == "reason").select(
        F.get_json_object("body", "$.reason").alias("reason"), F.get_json_object("body", "$.count").cast("long").alias("jobs")
    )


@query
def text_report(spark, sf):
    return reports.text_report(dv.datasets(spark, sf), dv.jobs(spark, sf)).select(
        "section", "item", F.round("value", 2).alias("value"), "text"
    )


@query
def event_rate(spark, sf):
    return rounded(metrics.event_rate(dv.table(spark, sf, "events")), 6)


# ---- calendar and hours ----------------------------------------------------------------------------------


def _persona_access(spark, sf):
    return dv.access(spark, sf)


@query
def calendar_access(spark, sf):
    """Hourly rows with the multipliers of the demand calendar in force."""
    return scenario.calendar_access(_persona_access(spark, sf))


@query
def calendar_effect(spark, sf):
    return rounded(scenario.calendar_effect(_persona_access(spark, sf)))


@query
def filled_hours(spark, sf):
    return scenario.fill_hours(dv.access(spark, sf))


@query
def filled_hours_of_events(spark, sf):
    """Hours from raw event times, which lie anywhere within the hour."""
    e = dv.table(spark, sf, "events")
    one = F.lit(1).cast("long")
    return scenario.fill_hours(e.select(
        dv.dataset_key(F.col("user_id")).alias("dataset_id"), dv.epoch("ts").alias("timestamp"), one.alias("reads_1h"),
        F.lit(0).cast("long").alias("writes_1h"), F.col("event_id").alias("bytes_read_1h"),
    ))


# ---- sources and sinks -----------------------------------------------------------------------------------


@query
def appended_requests(spark, sf):
    """The stored request table after one more request."""
    path = f"{run_folder(spark)}/requests"
    append_request(dv.requests(spark, sf), path)
    append_request(jb.new_request(spark, "full-scan-1", NOW), path)
    return spark.read.parquet(path).select("request_id", "status", "created_at", "reason")


@query
def training_csv(spark, sf):
    """Training features written as a CSV file and read back by the training reader."""
    path = f"{run_folder(spark)}/training"
    table = ft.training_table(_access(spark, sf))
    table.withColumn("timestamp", F.timestamp_seconds("timestamp")).write.option("header", True).csv(path)
    return rounded(read_training_csv(spark, path))


@query
def reused_features(spark, sf):
    """Training features stored for their input: asked for again with the same input they are only read, with other input they
    are computed anew."""
    path = f"{run_folder(spark)}/features"
    access = _access(spark, sf)
    early = staged(access.filter(F.col("timestamp") < CUT_HOUR * 3600))
    out = None
    for name, rows in [("all", access), ("early", early), ("all again", access)]:
        kept = reused(path, lambda rows=rows: ft.training_table(rows), [rows], ROLLING_HOURS)
        part = kept.select(F.lit(name).alias("input"), "dataset_id", "timestamp", "reads_24h", "trend_6h")
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def _log_lines(spark, sf):
    """A pipe table with a header and one row per event type, and a malformed row."""
    log = dv.run_log(spark, sf).groupBy("service").agg(F.count("*").alias("n"), F.max("p95_latency_ms").alias("p95"))
    cell = lambda c: F.col(c).cast("string")
    row = F.concat(
        F.lit("| "), cell("n"), F.lit(" | "), cell("n"), F.lit(" | 2.5 | "), (F.col("n") / 2.5).cast("string"), F.lit(" | "),
        (F.col("n") * 1440).cast("double").cast("string"), F.lit(" | "), cell("p95"), F.lit(" |"),
    )
    rows = log.agg(F.array_join(F.sort_array(F.collect_list(row)), "\n").alias("rows"))  # one row per event type
    head = "| events | accepted | duration_sec | events_per_sec | events_per_hour | p95_latency_ms |\n|---|---|---|---|---|---|\n"
    return rows.select(F.concat(F.lit("# Runs\n\n" + head), "rows", F.lit("\n| broken | row |\n")).alias("value"))


@query
def imported_run_log(spark, sf):
    """Run-log rows read from a text table."""
    path = f"{run_folder(spark)}/log"
    _log_lines(spark, sf).write.text(path)
    return rounded(read_pipe_log(spark, path).filter("events is not null").drop("ts", "service"))


@query
def logged_runs(spark, sf):
    """The newest row of a run log to which one row per event type has been appended."""
    path = f"{run_folder(spark)}/runs"
    log = dv.run_log(spark, sf).groupBy("service").agg(F.count("*").alias("n"))
    runs = log.select(
        "service", F.col("n").cast("double").alias("ts"), F.col("n").cast("double").alias("events"),
        F.col("n").cast("double").alias("accepted"), F.lit(2.5).alias("duration_sec"), (F.col("n") / 2.5).alias("events_per_sec"),
        (F.col("n") * 1440.0).alias("events_per_hour"), F.lit(1.0).alias("p95_latency_ms"),
    )
    append_run(runs.filter("service <> 'view'"), path)
    append_run(runs.filter("service = 'view'"), path)
    return rounded(latest_logged_run(spark.read.parquet(path)))


# ---- streaming -------------------------------------------------------------------------------------------


#: Waves in which the event files are published, and rows of a file, about.
WAVES, ROWS_PER_FILE = 4, 50_000


def _waves(rows: DataFrame, at: str) -> list[DataFrame]:
    """The rows in stretches of equal width of a column."""
    first, last = rows.agg(F.min(at), F.max(at)).first()
    if first is None:
        return [rows]
    step = (last - first) // WAVES + 1
    return [rows.filter((F.col(at) >= first + i * step) & (F.col(at) < first + (i + 1) * step)) for i in range(WAVES)]


def _streamed(spark, sf) -> Store:
    """The event pipeline over the whole event text: files of ranges of arrival, published in waves; after each wave the stream
    goes on from its checkpoint and merges what has come with the stored state."""
    folder = run_folder(spark)
    store = Store(spark, f"{folder}/store")
    for i, wave in enumerate(_waves(staged(_raw(spark, sf)), "seq")):
        write_event_files(wave, f"{folder}/events/{i:06d}", ["seq", "value"], ROWS_PER_FILE)
        ingest_stream(
            text_event_stream(spark, f"{folder}/events/*", by_name=True), store, f"{folder}/checkpoint", clock=lambda: NOW,
            trigger={"availableNow": True},
        ).awaitTermination()
    return store


@query
def streamed_state(spark, sf):
    return _state_row(_streamed(spark, sf).state.read())


@query
def streamed_jobs(spark, sf):
    made = _streamed(spark, sf).jobs.read()
    return made.select("dataset_id", "from_backend", "to_backend", "reason", "status", "attempts", "created_at")


@query
def streamed_dead_letters(spark, sf):
    return _streamed(spark, sf).dead_letters().select("error", "payload", "ts")


@query
def streamed_run_log(spark, sf):
    """What the batches of the stream have written to the run log."""
    return _streamed(spark, sf).run_log().select("batch", "service", "ts", "events", "accepted")


@query
def streamed_state_without_replays(spark, sf):
    """State of a stream whose files bring a part of the events of the wave before once more."""
    folder = run_folder(spark)
    store = Store(spark, f"{folder}/store")
    before = None
    for i, wave in enumerate(_waves(staged(_raw(spark, sf)), "seq")):
        published = wave if before is None else wave.unionByName(before.filter(F.col("seq") % 3 == 0))
        before = wave
        write_event_files(published, f"{folder}/events/{i:06d}", ["seq", "value"], ROWS_PER_FILE)
        ingest_stream(
            text_event_stream(spark, f"{folder}/events/*", by_name=True), store, f"{folder}/checkpoint", clock=lambda: NOW,
            trigger={"availableNow": True}, order_by="event_time", replays="30 days",
        ).awaitTermination()
    return _state_row(store.state.read())


@query
def streamed_scans(spark, sf):
    """Jobs made by a stream of requests over stored datasets and jobs."""
    folder = run_folder(spark)
    store = Store(spark, f"{folder}/store")
    store.state.write(dv.datasets(spark, sf), "given")
    store.jobs.write(dv.jobs(spark, sf), "given")
    asked = dv.requests(spark, sf).filter(F.col("status") == "PENDING")
    wanted = asked.orderBy("created_at", "request_id").limit(2)  # two requests, so two scans
    store.requests.write(wanted, "given")
    wanted.write.parquet(f"{folder}/requests")
    ticks = spark.readStream.schema(REQUEST).parquet(f"{folder}/requests")
    scan_stream(ticks, store, f"{folder}/checkpoint", clock=lambda: NOW, trigger={"availableNow": True}).awaitTermination()
    left = store.requests.read().agg(F.count_if(F.col("status") == "COMPLETE")).scalar()
    made = store.jobs.read().filter(F.col("created_at") == NOW)
    return made.select("dataset_id", "from_backend", "to_backend", "reason", "status", "attempts", "created_at", left.alias("requests_done"))


@query
def streamed_event_rate(spark, sf):
    """Rates of a stream in closed windows. One event in fifty arrives two waves late; those whose window has been closed by
    then are counted."""
    folder = run_folder(spark)
    events = staged(dv.table(spark, sf, "events").select("event_id", "ts", F.floor(dv.epoch("ts") / 60).alias("minute")))
    first, last = events.agg(F.min("minute"), F.max("minute")).first()
    own = F.floor((F.col("minute") - (first or 0)) / (((last or 0) - (first or 0)) // WAVES + 1)).cast("int")
    wave = F.least(own + F.when(F.col("event_id") % 50 == 0, 2).otherwise(0), F.lit(WAVES - 1))
    arriving = staged(events.withColumn("wave", wave))
    for i in range(WAVES):
        arriving.filter(F.col("wave") == i).select("event_id", "ts").write.parquet(f"{folder}/events/{i:06d}")
        stream = spark.readStream.schema(arriving.select("event_id", "ts").schema).parquet(f"{folder}/events/*")
        write_rates(stream, f"{folder}/rates", f"{folder}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    out = rate_account(spark, f"{folder}/rates", f"{folder}/checkpoint", arriving)
    return out.select("part", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "events")


@query
def stored_dataset_detail(spark, sf):
    """One dataset out of the stored state; only its bucket is read."""
    store = Store(spark, f"{run_folder(spark)}/store")
    store.state.write(dv.datasets(spark, sf), "given")
    return _state_row(store.state.find("ds_000007"))


@query
def reads_quantiles(spark, sf):
    """Quantiles of hourly reads per tier, merged from stored sketches per tier and hour: whether the rank of each answer is within
    the bound, against the rows themselves."""
    access = _access(spark, sf)
    hourly = staged(quantile_sketches(access.withColumn("hour", F.col("hour_of_day")), "reads_1h", ["current_backend", "hour"]))
    asked = staged(merged_quantiles(hourly, ["current_backend"], [0.25, 0.5, 0.95]))
    off = rank_errors(access, "reads_1h", asked, ["current_backend"])
    return off.select("current_backend", "p", "n", (F.col("rank_error") <= RANK_ERROR).alias("within"))


# ---- features --------------------------------------------------------------------------------------------


def _access(spark, sf):
    return staged(dv.access(spark, sf))


@query
def training_features(spark, sf):
    return rounded(ft.training_table(_access(spark, sf)))


@query
def chronological_split(spark, sf):
    return _split(spark, sf).select(
        "dataset_id", "timestamp", "is_train", "part_pos", "part_rows"
    )


def _sample_rows(spark, sf, kind: str, horizon: int):
    table = staged(ft.training_table(_access(spark, sf)))
    rows = ft.feature_rows(table, kind)
    features = [c for c in rows.columns if c.startswith("f_")]
    samples = ft.sequence_samples(rows, features, horizon)

    # The matrix as numbers that compare: the sum of each of its twelve columns, weighted by the row number.
    def check(j: int):
        add = lambda acc, i: acc + (i + 1) * F.get(F.get("x", i), F.lit(j))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ft.LOOKBACK - 1)), F.lit(0.0), add).alias(f"x{j:02d}")

    checks = [check(j) for j in range(len(features))]
    return rounded(samples.select("dataset_id", "timestamp", "target", *checks), 2)


@query
def sequence_samples_reads(spark, sf):
    return _sample_rows(spark, sf, "reads", 12)


@query
def sequence_samples_writes(spark, sf):
    return _sample_rows(spark, sf, "writes", 8)


def _split(spark, sf):
    return ft.chronological_split(staged(ft.training_table(_access(spark, sf))))


@query
def feature_scaler(spark, sf):
    rows = ft.feature_rows(_split(spark, sf), "reads")
    features = [c for c in rows.columns if c.startswith("f_")]
    return rounded(ft.fit_scaler(rows, features, 12), 3)


@query
def trend_backtest(spark, sf):
    return rounded(ft.backtest(_access(spark, sf), 12))


@query
def trend_backtest_8h(spark, sf):
    return rounded(ft.backtest(_access(spark, sf), 8))


@query
def backtest_errors(spark, sf):
    b = ft.backtest(_access(spark, sf), 12)
    parts = [
        metrics.forecast_errors(b, f"actual_{k}", f"predicted_{k}").withColumn("target", F.lit(k))
        for k in ("reads", "writes")
    ]
    return rounded(parts[0].unionByName(parts[1]), 3)


@query
def backtest_losses(spark, sf):
    b = ft.backtest(_access(spark, sf), 12)
    return rounded(
        metrics.losses(b, [("actual_reads", "predicted_reads"), ("actual_writes", "predicted_writes")]), 2
    )


@query
def best_horizon(spark, sf):
    """Horizon with the smaller mean error of the clipped-trend forecast, per target."""
    rows = None
    access = _access(spark, sf)
    for i, h in enumerate(ft.HORIZONS):
        b = ft.backtest(access, h)
        for k in ("reads", "writes"):
            e = metrics.forecast_errors(b, f"actual_{k}", f"predicted_{k}").select(
                F.lit(k).alias("target"), F.lit(f"{h}h").alias("name"), F.lit(i).alias("ord"),
                F.col("mae").alias("val_mae"),
            )
            rows = e if rows is None else rows.unionByName(e)
    return rounded(metrics.best_model(rows), 3)


def _grid_split(spark, sf, features):
    """Training features on gap-free hours, split. Of the features only those that are used are written and so computed."""
    table = ft.training_table(staged(scenario.fill_hours(_access(spark, sf)))).select("dataset_id", *ft.ORDER, *features)
    return staged(ft.chronological_split(staged(table)).drop("part_pos", "part_rows"))


@query
def trained_forecast(spark, sf):
    """A joint forecaster of reads, writes and bytes from two inputs, so that SQL can solve it too: errors of both losses next to
    those of the training mean and of the clipped trend. A test compares the form with all inputs with numpy."""
    features = ("reads_24h", "writes_24h")
    split = _grid_split(spark, sf, features)
    out = None
    for horizon in ft.HORIZONS:
        part = model.joint_forecast(split, horizon, features=features, depth=1)
        out = part if out is None else out.unionByName(part)
    better = [(F.col("mae") < F.col(f"{k}_mae")).alias(f"beats_{k}") for k in ("mean", "trend")]
    return rounded(out.select("*", *better), 3)
