"""Reporting queries over dataset state and jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import HOURS_PER_MONTH, LIVE_MOVE_FEE, REPORT_LATENCY_PENALTY, REPORT_MOVE_FEE, TIERS
from ..functions import entries as en
from ..functions.numeric import percent
from ..functions.text import dollars, thousands
from ..sources.files import staged
from .forecast import with_windows
from .pricing import cost_on, current_tier, initial_tier, known_tier, summary_columns
from .quantiles import exact_quantile

DAY_HOURS = 24


def temperature(reads: Column, hot: float = 100, cold: float = 10) -> Column:
    """Class of the reads of a day; the divisor is 24 even for a shorter history."""
    per_hour = reads / DAY_HOURS
    return F.when(per_hour > hot, "hot").when(per_hour > cold, "warm").otherwise("cold")


def _price(tier: Column, field: str, tiers=TIERS) -> Column:
    out = None
    for t in tiers:
        value = F.lit(getattr(t, field))
        out = F.when(tier == t.name, value) if out is None else out.when(tier == t.name, value)
    return out


def observed(datasets: DataFrame, baseline: str = "current", tiers=TIERS) -> DataFrame:
    """Observed reads, writes and cost parts of each dataset with history: at its current tier (``opt_*``) and at the
    tier of the baseline, ``current`` or ``initial``. ``priced`` tells whether both have a price."""
    base = initial_tier() if baseline == "initial" else current_tier()
    rows = (
        datasets.filter(F.size("history") > 0)
        .withColumn("day", en.newest(F.col("history"), DAY_HOURS))
        .withColumns({"reads": en.total(F.col("day"), "reads_1h"), "writes": en.total(F.col("day"), "writes_1h")})
    )
    size = F.coalesce("size_gb", F.lit(0.0))

    def parts(tier: Column, prefix: str = "") -> list[Column]:
        access = F.col("reads") * _price(tier, "read", tiers) + F.col("writes") * _price(tier, "write", tiers)
        return [
            (size * _price(tier, "store", tiers) * F.lit(DAY_HOURS / HOURS_PER_MONTH)).alias(f"{prefix}storage"),
            access.alias(f"{prefix}access"),
            (F.col("reads") * _price(tier, "latency", tiers) * F.lit(REPORT_LATENCY_PENALTY)).alias(f"{prefix}latency"),
        ]

    return rows.select(
        "dataset_id", "reads", "writes", *parts(base), *parts(current_tier(), "opt_"),
        temperature(F.col("reads")).alias("temperature"),
        (known_tier(base, tiers) & known_tier(current_tier(), tiers)).alias("priced"),
    )


PARTS = ("storage", "access", "latency", "opt_storage", "opt_access", "opt_latency")


def _priced_sums() -> list[Column]:
    """Cost parts over the datasets priced on both sides, and the number of the others."""
    add = lambda c: F.coalesce(F.sum(F.when(F.col("priced"), F.col(c))), F.lit(0.0)).alias(c)
    return [*map(add, PARTS), F.count_if(~F.col("priced")).alias("unpriced_datasets")]


def observed_baseline(datasets: DataFrame, baseline: str = "current") -> DataFrame:
    """Observed cost without moves: storage, access, latency and their total. ``baseline="initial"`` prices the
    initial instead of the current tier."""
    sums = observed(datasets, baseline).agg(*_priced_sums())
    total = F.col("storage") + F.col("access") + F.col("latency")
    return sums.select("storage", "access", "latency", total.alias("total"), "unpriced_datasets")


def _completed(jobs: DataFrame) -> Column:
    return jobs.agg(F.count_if(F.col("status") == "COMPLETE")).scalar()


def observed_optimized(datasets: DataFrame, jobs: DataFrame, fee: float = REPORT_MOVE_FEE) -> DataFrame:
    """Observed cost at the current tier plus a fee per completed job."""
    return (
        observed_baseline(datasets)
        .withColumn("migration", _completed(jobs) * F.lit(fee))
        .withColumn("total", F.col("total") + F.col("migration"))
    )


def savings(datasets: DataFrame, jobs: DataFrame, baseline: str = "current", fee: float = REPORT_MOVE_FEE) -> DataFrame:
    """Baseline, optimised cost, savings and their projection in one row; each table is read once. Only datasets with a
    price on both sides count, the others are told as a number."""
    sums = observed(datasets, baseline).agg(*_priced_sums())
    return sums.withColumn("migration", _completed(jobs) * F.lit(fee)).select(*savings_columns())


def savings_columns(unpriced: str = "unpriced_datasets") -> list[Column]:
    """Savings from columns with the sums of ``PARTS`` and ``migration``."""
    c = F.col
    baseline = c("storage") + c("access") + c("latency")
    optimized = c("opt_storage") + c("opt_access") + c("opt_latency") + c("migration")
    amount = baseline - optimized
    pct = F.when(baseline > 0, amount / baseline * 100).otherwise(F.lit(0.0))
    return [
        baseline.alias("baseline"), c("storage"), c("access"), c("latency"), optimized.alias("optimized"), c("opt_storage"),
        c("opt_access"), c("opt_latency"), c("migration"), amount.alias("savings"), pct.alias("savings_percent"),
        (amount * 30).alias("monthly"), (amount * 365).alias("annual"), c(unpriced).alias("unpriced_datasets"),
    ]


def access_patterns(datasets: DataFrame) -> DataFrame:
    """Day totals and the number of hot, warm and cold datasets."""
    is_ = lambda name: F.count_if(F.col("temperature") == name)
    return observed(datasets).agg(
        F.coalesce(F.sum("reads"), F.lit(0)).alias("total_reads_24h"),
        F.coalesce(F.sum("writes"), F.lit(0)).alias("total_writes_24h"),
        is_("hot").alias("hot_datasets"), is_("warm").alias("warm_datasets"), is_("cold").alias("cold_datasets"),
    )


def tier_distribution(datasets: DataFrame) -> DataFrame:
    """Count, size and share of datasets per tier, by tier name."""
    # Stored: the share and the order read these few rows again, not the datasets.
    per_tier = staged(datasets.groupBy(F.coalesce("current_backend", F.lit("unknown")).alias("backend")).agg(
        F.count("*").alias("datasets"), F.coalesce(F.sum("size_gb"), F.lit(0.0)).alias("total_gb")
    ))
    everything = per_tier.agg(F.sum("datasets")).scalar()
    return per_tier.withColumn("share", percent(F.col("datasets"), everything)).orderBy("backend")


def datasets_per_tier(datasets: DataFrame) -> DataFrame:
    return datasets.groupBy("current_backend").agg(F.count("*").alias("datasets"))


def job_counts(jobs: DataFrame) -> DataFrame:
    is_ = lambda name: F.count_if(F.col("status") == name)
    return jobs.agg(
        F.count("*").alias("total"), is_("PENDING").alias("pending"), is_("RUNNING").alias("running"),
        is_("COMPLETE").alias("completed"), is_("FAILED").alias("failed"),
    )


def migration_counts(jobs: DataFrame) -> DataFrame:
    """Jobs by status and by reason as ``(kind, item, jobs)``. COMPLETE and FAILED always appear. One aggregation by the
    pair; a hot reason combines before the shuffle."""
    return _counted(jobs.groupBy("status", "reason").agg(F.count("*").alias("jobs")))


def _timed(jobs: DataFrame) -> DataFrame:
    """Zero durations do not count."""
    return jobs.withColumn("d", F.when(F.col("duration_sec") != 0, F.col("duration_sec")))


def migration_efficiency(jobs: DataFrame) -> DataFrame:
    """Totals, success rate and duration statistics of the jobs in one row."""
    done = F.count_if(F.col("status") == "COMPLETE")
    failed = F.count_if(F.col("status") == "FAILED")
    timed = _timed(jobs)
    median = exact_quantile(timed, "d", 0.5, "inclusive").select("value").scalar()
    return timed.agg(
        F.count("*").alias("total"),
        percent(done, done + failed).alias("success_rate"),
        F.coalesce(F.avg("d"), F.lit(0.0)).alias("avg_duration"),
        F.min("d").alias("min_duration"),
        F.max("d").alias("max_duration"),
    ).withColumn("median_duration", median)


def duration_histogram(jobs: DataFrame, bounds=(5.0, 10.0, 20.0, 30.0, 40.0)) -> DataFrame:
    """Completed jobs up to each bound, then all; one pass."""
    d = F.col("duration_sec")
    done = jobs.filter((F.col("status") == "COMPLETE") & d.isNotNull())
    counts = done.agg(*[F.count_if(d <= b).alias(f"b{i}") for i, b in enumerate(bounds)], F.count("*").alias("all"))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("jobs")) for i, b in enumerate(bounds)]
    return counts.select(F.inline(F.array(*rows, F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("jobs")))))


def totals(datasets: DataFrame, jobs: DataFrame) -> DataFrame:
    n_jobs = jobs.agg(F.count("*")).scalar()
    return datasets.agg(F.count("*").alias("total_datasets")).withColumn("total_migrations", n_jobs)


def latest_metric(run_log: DataFrame, service: str = "benchmark") -> DataFrame:
    """Newest metric row of a service."""
    return latest_metrics(run_log).filter(F.col("service") == service)


def latest_metrics(run_log: DataFrame) -> DataFrame:
    """Newest metric row of every service; of rows with one time the one with the largest values, in column order."""
    values = [c for c in run_log.columns if c not in ("service", "ts")]
    newest = run_log.groupBy("service").agg(F.max(F.struct("ts", *values)).alias("row"))
    return newest.select("service", "row.*")


def _one(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct value."""
    return df.select(F.struct("*")).scalar()


def dataset_aggregate(datasets: DataFrame) -> DataFrame:
    """Stored figures per current tier (null is its own group) from one pass over the datasets. Every section about
    datasets is a sum over these rows."""
    w = with_windows(datasets)
    seen = F.col("n") > 0
    tier = current_tier()
    reads, writes, size = F.col("sum_reads"), F.col("sum_writes"), F.coalesce("size_gb", F.lit(0.0))
    storage = size * _price(tier, "store") * F.lit(DAY_HOURS / HOURS_PER_MONTH)
    access = reads * _price(tier, "read") + writes * _price(tier, "write")
    latency = reads * _price(tier, "latency") * F.lit(REPORT_LATENCY_PENALTY)
    wide = w.select(
        "current_backend", "size_gb", seen.alias("seen"), reads.alias("reads"), writes.alias("writes"),
        temperature(reads).alias("temperature"), known_tier(tier).alias("known"), storage.alias("storage"),
        access.alias("access"), latency.alias("latency"), cost_on(initial_tier()).alias("initial_cost"),
        cost_on(tier).alias("current_cost"),
    )
    c = F.col
    both = c("initial_cost").isNotNull() & c("current_cost").isNotNull()
    add = lambda name, when: F.coalesce(F.sum(F.when(when, c(name))), F.lit(0.0)).alias(name)
    count = lambda name: F.coalesce(F.sum(F.when(c("seen"), c(name))), F.lit(0)).alias(name)
    return staged(wide.groupBy("current_backend").agg(
        F.count("*").alias("datasets"), F.coalesce(F.sum("size_gb"), F.lit(0.0)).alias("total_gb"),
        count("reads"), count("writes"),
        *[F.count_if(c("seen") & (c("temperature") == t)).alias(t) for t in ("hot", "warm", "cold")],
        *[add(p, c("seen") & c("known")) for p in ("storage", "access", "latency")],
        F.count_if(c("seen") & ~c("known")).alias("unpriced_now"),
        add("initial_cost", both), add("current_cost", both), F.count_if(~both).alias("unpriced_datasets"),
    ))


def job_aggregate(jobs: DataFrame) -> DataFrame:
    """Stored figures per status and reason from one pass over the jobs."""
    d = F.when(F.col("duration_sec") != 0, F.col("duration_sec"))
    return staged(jobs.groupBy("status", "reason").agg(
        F.count("*").alias("jobs"), F.sum(d).alias("time"), F.count(d).alias("timed"), F.min(d).alias("least"),
        F.max(d).alias("most"),
    ))


def _job_totals(groups: DataFrame) -> DataFrame:
    """One row over all groups: counts per status and durations."""
    is_ = lambda name: F.coalesce(F.sum(F.when(F.col("status") == name, F.col("jobs"))), F.lit(0)).alias(name)
    return groups.agg(
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("total"), *map(is_, ("PENDING", "RUNNING", "COMPLETE", "FAILED")),
        F.coalesce(F.sum("time") / F.sum("timed"), F.lit(0.0)).alias("avg_duration"), F.min("least").alias("min_duration"),
        F.max("most").alias("max_duration"),
    )


def _efficiency(groups: DataFrame, jobs: DataFrame) -> DataFrame:
    median = exact_quantile(_timed(jobs), "d", 0.5, "inclusive").select("value").scalar()
    done, failed = F.col("COMPLETE"), F.col("FAILED")
    return _job_totals(groups).select(
        "total", percent(done, done + failed).alias("success_rate"), "avg_duration", "min_duration", "max_duration",
        median.alias("median_duration"), F.col("COMPLETE").alias("moves"),
    )


def _dataset_totals(tiers: DataFrame, moves: Column) -> DataFrame:
    """One row over all tiers: report costs with their savings, live costs, access."""
    add = lambda name: F.sum(name).alias(name)
    sums = tiers.agg(
        F.coalesce(F.sum("datasets"), F.lit(0)).alias("total_datasets"),
        *[F.coalesce(F.sum(p), F.lit(0.0)).alias(p) for p in ("storage", "access", "latency")],
        *[F.coalesce(F.sum(p), F.lit(0.0)).alias(f"opt_{p}") for p in ("storage", "access", "latency")],
        F.coalesce(F.sum("initial_cost"), F.lit(0.0)).alias("b"), F.coalesce(F.sum("current_cost"), F.lit(0.0)).alias("o"),
        *map(add, ("reads", "writes", "hot", "warm", "cold", "unpriced_now", "unpriced_datasets")),
    )
    return sums.withColumn("moves", moves)


def overview(datasets: DataFrame, jobs: DataFrame, run_log: DataFrame, service: str = "benchmark") -> DataFrame:
    """The dashboard row: totals, datasets per tier, job counts, costs and the latest throughput. Datasets and jobs are
    read once each; tiers are few, so one array holds their counts."""
    tiers, groups = dataset_aggregate(datasets), job_aggregate(jobs)
    counts = _job_totals(groups)
    listed = tiers.agg(F.sort_array(F.collect_list(F.struct("current_backend", "datasets"))).alias("d")).scalar()
    totals_ = _dataset_totals(tiers, counts.select("COMPLETE").scalar()).withColumn("m", F.col("moves") * F.lit(LIVE_MOVE_FEE))
    rate = latest_metric(run_log, service).select(F.struct("events_per_sec", "events_per_hour", "p95_latency_ms"))
    speed = F.col("speed")
    rounded = lambda f: F.round(F.coalesce(speed[f], F.lit(0.0)), 2).alias(f)
    named = counts.select("total", *[F.col(s).alias(n) for s, n in STATUS_NAMES.items()])
    one = totals_.select(
        "total_datasets", listed.alias("backend_distribution"), _one(named).alias("migrations"),
        F.struct(*summary_columns()).alias("costs"), rate.scalar().alias("speed"),
    )
    return one.select(
        "total_datasets", "backend_distribution", "migrations", "costs",
        F.struct(*[rounded(f) for f in ("events_per_sec", "events_per_hour", "p95_latency_ms")]).alias("throughput"),
    )


STATUS_NAMES = {"PENDING": "pending", "RUNNING": "running", "COMPLETE": "completed", "FAILED": "failed"}


def _counted(groups: DataFrame) -> DataFrame:
    """Jobs by status and by reason as ``(kind, item, jobs)``. COMPLETE and FAILED always appear. A reason may be as rare
    as its job, so this stays a distributed table."""
    lines = groups.select(F.inline(F.array(
        F.struct(F.lit("status").alias("kind"), F.coalesce("status", F.lit("UNKNOWN")).alias("item"), F.col("jobs").alias("jobs")),
        F.struct(F.lit("reason").alias("kind"), F.coalesce("reason", F.lit("Unknown")).alias("item"), F.col("jobs").alias("jobs")),
    )))
    zero = lambda s: F.struct(F.lit("status").alias("kind"), F.lit(s).alias("item"), F.lit(0).cast("long").alias("jobs"))
    always = groups.sparkSession.range(1).select(F.inline(F.array(zero("COMPLETE"), zero("FAILED"))))
    return lines.unionByName(always).groupBy("kind", "item").agg(F.sum("jobs").alias("jobs"))


def json_report(datasets: DataFrame, jobs: DataFrame, generated_at: str) -> DataFrame:
    """The report as rows ``(part, body)`` of JSON text: one ``report`` row with everything of fixed size, and one
    ``reason`` row per job reason. Reasons carry figures, so there may be as many as jobs, too many for one row; written
    as JSON lines they stay distributed."""
    groups = job_aggregate(jobs)
    report = nested_report(datasets, jobs, generated_at, groups).select(
        F.lit("report").alias("part"), F.to_json(F.struct("*")).alias("body")
    )
    reasons = _counted(groups).filter(F.col("kind") == "reason").select(
        F.lit("reason").alias("part"), F.to_json(F.struct(F.col("item").alias("reason"), F.col("jobs").alias("count"))).alias("body")
    )
    return report.unionByName(reasons)


def nested_report(datasets: DataFrame, jobs: DataFrame, generated_at: str, groups: DataFrame | None = None) -> DataFrame:
    """The part of the report that has a fixed size, as one nested row."""
    tiers = dataset_aggregate(datasets)
    groups = job_aggregate(jobs) if groups is None else groups
    by_status = _counted(groups.groupBy("status").agg(F.sum("jobs").alias("jobs")).withColumn("reason", F.lit(None).cast("string"))).filter(
        F.col("kind") == "status"
    ).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("item", "jobs"))))).scalar()
    backends = tiers.groupBy(F.coalesce("current_backend", F.lit("unknown")).alias("backend")).agg(
        F.sum("datasets").alias("count"), F.sum("total_gb").alias("total_gb")
    ).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("backend", F.struct("count", "total_gb").alias("v")))))).scalar()
    e = _efficiency(groups, jobs)
    totals_ = _dataset_totals(tiers, _job_totals(groups).select("COMPLETE").scalar()).withColumn(
        "migration", F.col("moves") * F.lit(REPORT_MOVE_FEE)
    ).withColumn("unpriced_datasets", F.col("unpriced_now"))
    one = totals_.select(
        F.struct("total_datasets").alias("d"), F.struct(*savings_columns()).alias("s"), _one(e).alias("e"),
        by_status.alias("by_status"), backends.alias("backends"),
        F.struct(
            F.col("reads").alias("total_reads_24h"), F.col("writes").alias("total_writes_24h"), F.col("hot").alias("hot_datasets"),
            F.col("warm").alias("warm_datasets"), F.col("cold").alias("cold_datasets"),
        ).alias("access_patterns"),
    )
    c = F.col
    return one.select(
        F.lit(generated_at).alias("generated_at"),
        F.struct(c("d.total_datasets"), c("e.total").alias("total_migrations")).alias("system"),
        F.struct(
            F.struct(
                c("s.baseline").alias("total"), F.struct(c("s.storage"), c("s.access"), c("s.latency")).alias("breakdown"),
            ).alias("baseline"),
            F.struct(
                c("s.optimized").alias("total"),
                F.struct(
                    c("s.opt_storage").alias("storage"), c("s.opt_access").alias("access"),
                    c("s.opt_latency").alias("latency"), c("s.migration"),
                ).alias("breakdown"),
            ).alias("optimized"),
            F.struct(
                c("s.savings").alias("amount"), c("s.savings_percent").alias("percentage"), c("s.monthly"),
                c("s.annual"),
            ).alias("savings"),
            c("s.unpriced_datasets"),
        ).alias("costs"),
        F.struct(
            F.struct(
                c("e.total"), "by_status", c("e.avg_duration"), c("e.success_rate"), c("e.median_duration"),
                c("e.min_duration"), c("e.max_duration"),
            ).alias("efficiency")
        ).alias("migrations"),
        "backends", "access_patterns",
    )


def text_report(datasets: DataFrame, jobs: DataFrame) -> DataFrame:
    """The report as lines ``(section, item, value, text)``."""
    plain = lambda c: c.cast("string")
    secs = lambda c: F.format_string("%.2fs", c)
    pct = lambda c: F.format_string("%.1f%%", c)
    tiers, groups = dataset_aggregate(datasets), job_aggregate(jobs)

    def lines(row: DataFrame, items) -> DataFrame:
        return row.select(F.inline(F.array(*[
            F.struct(
                F.lit(section).alias("section"), F.lit(item).alias("item"), F.col(name).cast("double").alias("value"),
                show(F.col(name)).alias("text"),
            )
            for section, items_ in items.items() for item, name, show in items_
        ])))

    totals_ = _dataset_totals(tiers, _job_totals(groups).select("COMPLETE").scalar()).withColumn(
        "migration", F.col("moves") * F.lit(REPORT_MOVE_FEE)
    )
    about_data = totals_.select("*", F.struct(*savings_columns("unpriced_now")).alias("s")).select(
        "total_datasets", "s.*", "reads", "writes", "hot", "warm", "cold"
    )
    data = lines(about_data, {
        "system": [("total datasets", "total_datasets", plain)],
        "cost": [
            ("baseline", "baseline", dollars), ("baseline storage", "storage", dollars),
            ("baseline access", "access", dollars), ("baseline latency", "latency", dollars),
            ("optimized", "optimized", dollars), ("optimized storage", "opt_storage", dollars),
            ("optimized access", "opt_access", dollars), ("optimized latency", "opt_latency", dollars),
            ("optimized migration", "migration", dollars), ("savings", "savings", dollars),
            ("savings percent", "savings_percent", pct), ("monthly savings", "monthly", dollars),
            ("annual savings", "annual", dollars), ("unpriced datasets", "unpriced_datasets", plain),
        ],
        "access": [
            ("total reads", "reads", thousands), ("total writes", "writes", thousands), ("hot datasets", "hot", plain),
            ("warm datasets", "warm", plain), ("cold datasets", "cold", plain),
        ],
    })
    moved = lines(_efficiency(groups, jobs), {
        "system": [("total migrations", "total", plain)],
        "migrations": [
            ("total", "total", plain), ("success rate", "success_rate", pct), ("average duration", "avg_duration", secs),
            ("median duration", "median_duration", secs), ("min duration", "min_duration", secs),
            ("max duration", "max_duration", secs),
        ],
    })
    counted = _counted(groups).select(
        F.concat(F.lit("jobs by "), "kind").alias("section"), "item", F.col("jobs").cast("double").alias("value"),
        F.col("jobs").cast("string").alias("text"),
    )
    per_tier = tiers.groupBy(F.coalesce("current_backend", F.lit("unknown")).alias("item")).agg(
        F.sum("datasets").alias("n"), F.sum("total_gb").alias("gb")
    )
    all_ = tiers.agg(F.sum("datasets")).scalar()
    share = percent(F.col("n"), all_)
    spread = per_tier.select(
        F.lit("tiers").alias("section"), "item", F.col("n").cast("double").alias("value"),
        F.format_string("%d datasets, %.1f GB, share %.1f%%", "n", "gb", share).alias("text"),
    )
    return data.unionByName(moved).unionByName(counted).unionByName(spread)
