"""Migration jobs as a table: creation, claim, outcome and the tier change that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..config import LIMITS, Limits
from ..functions.text import scheduled_reason
from ..schemas import JOB, REQUEST
from ..sources.files import staged
from .placement import evaluate_placement, should_migrate
from .state import with_history

PENDING, RUNNING, COMPLETE, FAILED = "PENDING", "RUNNING", "COMPLETE", "FAILED"
JOB_KEY = ("dataset_id", "reason")


def job_id(dataset_id: Column, reason: Column, created_at: Column) -> Column:
    return F.sha2(F.concat_ws("|", dataset_id, reason, created_at.cast("string")), 256)


def create_jobs(candidates: DataFrame, jobs: DataFrame, now: float) -> DataFrame:
    """New PENDING jobs for ``(dataset_id, from_backend, to_backend, reason[, ord])``.

    One job per dataset and reason, the one with the smallest ``ord`` when there are several, and none where
    such a job is already pending. Both sides are reduced to one row per key before they meet.
    """
    order = F.col("ord") if "ord" in candidates.columns else F.lit(0)
    wanted = candidates.groupBy(*JOB_KEY).agg(
        F.min(F.struct(order.alias("ord"), "from_backend", "to_backend")).alias("first")
    )
    pending = jobs.filter(F.col("status") == PENDING).select(*JOB_KEY).distinct()
    fresh = wanted.join(pending, list(JOB_KEY), "left_anti")
    created = F.lit(float(now))
    values = {
        "job_id": job_id(F.col("dataset_id"), F.col("reason"), created),
        "dataset_id": F.col("dataset_id"),
        "from_backend": F.col("first.from_backend"),
        "to_backend": F.col("first.to_backend"),
        "reason": F.col("reason"),
        "status": F.lit(PENDING),
        "attempts": F.lit(0),
        "created_at": created,
    }
    return fresh.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in JOB])


def scan(
    datasets: DataFrame, jobs: DataFrame, now: float, limits: Limits = LIMITS, one_per_target: bool = False
) -> DataFrame:
    """New jobs for every dataset whose best tier is not its current one.

    The reason carries the savings, so a changed figure makes another pending job for the same dataset. With
    ``one_per_target`` a dataset gets no second pending job to the same tier.
    """
    moves = (
        evaluate_placement(with_history(datasets), limits)
        .filter(should_migrate(F.col("current_backend"), F.col("target_backend")))
        .select(
            "dataset_id", F.col("current_backend").alias("from_backend"), F.col("target_backend").alias("to_backend"),
            scheduled_reason(F.col("reason"), F.col("savings"), F.col("savings_percent")).alias("reason"),
        )
    )
    if one_per_target:
        pending = jobs.filter(F.col("status") == PENDING).select("dataset_id", "to_backend").distinct()
        moves = moves.join(pending, ["dataset_id", "to_backend"], "left_anti")
    return create_jobs(moves, jobs, now)


def eligible(now: float) -> Column:
    return (F.col("status") == PENDING) & (F.col("retry_after").isNull() | (F.col("retry_after") <= now))


def _marked(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Adds ``hit``: whether the key is among the ids. Spark sees how many there are and picks the join."""
    ids = ids.select(F.col(key).alias("hit_key"))
    joined = table.join(ids, table[key] == F.col("hit_key"), "left")
    return joined.withColumn("hit", F.col("hit_key").isNotNull()).drop("hit_key")


#: Up to so many rows are picked by each task's own first rows, merged; more by ranges.
FEW = 10_000


def first_rows(df: DataFrame, order: list[str], n: int, few: int = FEW) -> DataFrame:
    """The ``n`` first rows in a total order. No task sorts them all: rows are laid out in ranges of the order, counts per
    range tell which ranges are whole, and only the range where the n-th row lies is numbered."""
    if n <= few:
        return df.orderBy(*order).limit(n)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = staged(df.repartitionByRange(ranges, *order).withColumn("range_no", F.spark_partition_id()))
    sizes = laid.groupBy("range_no").agg(F.count("*").alias("rows_in"))
    upto = F.sum("rows_in").over(W.orderBy("range_no").rowsBetween(W.unboundedPreceding, 0))
    reach = sizes.select("range_no", (upto - F.col("rows_in")).alias("rows_before"), upto.alias("rows_upto"))
    placed = laid.join(F.broadcast(reach.filter(F.col("rows_before") < n)), "range_no")  # a row per range
    own = F.row_number().over(W.partitionBy("range_no").orderBy(*order))
    last = placed.filter(F.col("rows_upto") > n).withColumn("own", own).filter(F.col("own") <= n - F.col("rows_before"))
    return placed.filter(F.col("rows_upto") <= n).select(*df.columns).unionByName(last.select(*df.columns))


def next_jobs(jobs: DataFrame, now: float, n: int = 1) -> DataFrame:
    """The ``n`` oldest jobs that may run now; equal times by id."""
    return first_rows(jobs.filter(eligible(now)), ["created_at", "job_id"], n)


def _start(now: float) -> dict[str, Column]:
    return {
        "status": F.lit(RUNNING),
        "started_at": F.lit(float(now)),
        "attempts": F.coalesce("attempts", F.lit(0)) + 1,
    }


def claimed(jobs: DataFrame, now: float, n: int = 1) -> DataFrame:
    """The claimed jobs as they are after the claim."""
    return next_jobs(jobs, now, n).withColumns(_start(now)).select(*JOB.names)


def claim_jobs(jobs: DataFrame, now: float, n: int = 1) -> DataFrame:
    """The whole job table after claiming up to ``n`` jobs."""
    marked = _marked(jobs, next_jobs(jobs, now, n), "job_id")
    return marked.withColumns({k: F.when(F.col("hit"), v).otherwise(F.col(k)) for k, v in _start(now).items()}).select(
        *JOB.names
    )


def apply_outcomes(jobs: DataFrame, outcomes: DataFrame, now: float, limits: Limits = LIMITS) -> DataFrame:
    """The whole job table after outcomes ``(job_id, success, error, duration_sec)``.

    A success completes the job. A failure puts it back with a growing delay until its attempts are used up. Of several
    outcomes of one job a success counts before a failure, then the longer duration, then the later error text.
    """
    one = outcomes.groupBy(F.col("job_id").alias("o_id")).agg(
        F.max(F.struct("success", "duration_sec", "error")).alias("o")
    )
    o = one.select(
        "o_id", F.col("o.success").alias("o_ok"), F.col("o.error").alias("o_error"),
        F.col("o.duration_sec").alias("o_duration"),
    )
    joined = jobs.join(o, jobs["job_id"] == F.col("o_id"), "left")
    done = F.col("o_ok")
    broken = ~F.col("o_ok")
    tries = F.coalesce("attempts", F.lit(1))
    final = broken & (tries >= limits.max_attempts)
    again = broken & (tries < limits.max_attempts)
    clock = F.lit(float(now))
    return joined.withColumns({
        "status": F.when(done, COMPLETE).when(final, FAILED).when(again, PENDING).otherwise(F.col("status")),
        "finished_at": F.when(done | final, clock).otherwise(F.col("finished_at")),
        "duration_sec": F.when(done, F.round("o_duration", 3)).otherwise(F.col("duration_sec")),
        "error": F.when(broken, F.col("o_error")).otherwise(F.col("error")),
        "retry_after": F.when(again, clock + limits.retry_backoff_sec * tries).otherwise(F.col("retry_after")),
    }).select(*JOB.names)


def apply_moves(datasets: DataFrame, completed: DataFrame, now: float | None = None) -> DataFrame:
    """Set the tier of every dataset to the target of its last completed job ``(dataset_id, to_backend, job_id,
    started_at, created_at)``. Jobs of unknown datasets change nothing."""
    at = F.lit(float(now)) if now is not None else F.col("finished_at")
    last = completed.groupBy("dataset_id").agg(
        F.max(F.struct("started_at", "created_at", "job_id", "to_backend", at.alias("at"))).alias("move")
    ).withColumnRenamed("dataset_id", "moved_id")
    joined = datasets.join(last, datasets["dataset_id"] == F.col("moved_id"), "left")
    return joined.withColumns({
        "current_backend": F.coalesce("move.to_backend", "current_backend"),
        "last_migrated_at": F.coalesce("move.at", "last_migrated_at"),
    }).select(*datasets.columns)


def reclaim(jobs: DataFrame, now: float, after_sec: float) -> DataFrame:
    """Put jobs back that have been running for longer than ``after_sec``. Off unless called."""
    stuck = (F.col("status") == RUNNING) & (F.col("started_at") < now - after_sec)
    return jobs.withColumn("status", F.when(stuck, PENDING).otherwise(F.col("status")))


def recent_jobs(jobs: DataFrame, n: int = 100) -> DataFrame:
    """Newest jobs first; equal times by id."""
    return jobs.orderBy(F.col("created_at").desc(), "job_id").limit(n)


def new_request(datasets_or_spark, request_id: str, now: float, reason: str = "api-full-scan") -> DataFrame:
    """One pending analysis request, ready to be appended."""
    spark = getattr(datasets_or_spark, "sparkSession", datasets_or_spark)
    return spark.createDataFrame([(request_id, PENDING, float(now), reason, None, None, None)], REQUEST)


def next_request(requests: DataFrame) -> DataFrame:
    """The oldest pending request, equal times by id."""
    return requests.filter(F.col("status") == PENDING).orderBy("created_at", "request_id").limit(1)


def claim_request(requests: DataFrame, now: float) -> DataFrame:
    """The request table after the oldest pending request has started."""
    marked = _marked(requests, next_request(requests), "request_id")
    return marked.withColumns({
        "status": F.when(F.col("hit"), RUNNING).otherwise(F.col("status")),
        "started_at": F.when(F.col("hit"), F.lit(float(now))).otherwise(F.col("started_at")),
    }).select(*REQUEST.names)


def finish_request(requests: DataFrame, request_id: Column | str, now: float, jobs_created: Column) -> DataFrame:
    """Complete one running request with the number of jobs its scan made. Others that run are left alone."""
    wanted = F.lit(request_id) if isinstance(request_id, str) else request_id
    hit = (F.col("status") == RUNNING) & (F.col("request_id") == wanted)
    return requests.withColumns({
        "finished_at": F.when(hit, F.lit(float(now))).otherwise(F.col("finished_at")),
        "jobs_created": F.when(hit, jobs_created).otherwise(F.col("jobs_created")),
        "status": F.when(hit, COMPLETE).otherwise(F.col("status")),
    }).select(*REQUEST.names)
