"""Cost of a dataset on a tier, and cost totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import DEFAULT_TIER, HOURS_PER_MONTH, LIVE_LATENCY_PENALTY, LIVE_MOVE_FEE, TIERS, Tier
from ..functions.numeric import percent
from .forecast import HOURS, with_windows


def price_table(spark: SparkSession, tiers: tuple[Tier, ...] = TIERS) -> DataFrame:
    rows = [(i, t.name, t.store, t.read, t.write, t.egress, t.ingress, t.latency) for i, t in enumerate(tiers)]
    return spark.createDataFrame(
        rows,
        "ord int, backend string, p_store double, p_read double, p_write double, p_egress double, p_ingress double, "
        "p_latency double",
    )


def current_tier() -> Column:
    return F.coalesce("current_backend", F.lit(DEFAULT_TIER))


def initial_tier() -> Column:
    """Initial tier; null or empty falls back to the current one."""
    return F.coalesce(F.nullif(F.col("initial_backend"), F.lit("")), "current_backend", F.lit(DEFAULT_TIER))


def tier_cost(tier: Tier, with_latency: Column | bool = True, hours: int = HOURS) -> Column:
    """Cost of the window on one tier from ``size_gb``, ``fc_reads`` and ``fc_writes``."""
    size = F.coalesce(F.col("size_gb"), F.lit(0.0))
    reads, writes = F.col("fc_reads"), F.col("fc_writes")
    storage = size * F.lit(tier.store) * F.lit(hours / HOURS_PER_MONTH)
    access = reads * F.lit(tier.read) + writes * F.lit(tier.write)
    latency = reads * F.lit(tier.latency) * F.lit(LIVE_LATENCY_PENALTY)
    if with_latency is False:
        latency = F.lit(0.0)
    elif with_latency is not True:
        latency = F.when(with_latency, latency).otherwise(F.lit(0.0))
    return F.when(F.col("n") == 0, F.lit(0.0)).otherwise(storage + access + latency)


def cost_on(tier_name: Column, tiers=TIERS, with_latency: Column | bool = True, hours: int = HOURS) -> Column:
    """Cost on the tier named by a column. The price list is a handful of rows, so the lookup is a CASE, not a join.
    Null for an unknown tier unless the history is empty."""
    out = F.when(F.col("n") == 0, F.lit(0.0))
    for tier in tiers:
        out = out.when(tier_name == tier.name, tier_cost(tier, with_latency, hours))
    return out


def window_cost(datasets: DataFrame, tier_name: Column, hours: int = HOURS, tiers=TIERS,
                with_latency: bool = True) -> DataFrame:
    """Cost of each dataset on one tier for the next ``hours``."""
    return with_windows(datasets, hours).select(
        "dataset_id", tier_name.alias("backend"), cost_on(tier_name, tiers, with_latency, hours).alias("cost")
    )


def tier_costs(datasets: DataFrame, tiers=TIERS, hours: int = HOURS) -> DataFrame:
    """One row per dataset and tier, with and without the latency cost. Rows are made in place by an explode."""
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("ord"), F.lit(t.name).alias("backend"), tier_cost(t, True, hours).alias("cost"),
            tier_cost(t, False, hours).alias("cost_without_latency"),
        )
        for i, t in enumerate(tiers)
    ])
    return with_windows(datasets, hours).select("dataset_id", F.inline(rows))


def known_tier(tier_name: Column, tiers=TIERS) -> Column:
    return tier_name.isin(*[t.name for t in tiers])


def unpriced(datasets: DataFrame, tiers=TIERS) -> DataFrame:
    """Datasets with history whose current or initial tier is not in the price list."""
    bad = ~known_tier(current_tier(), tiers) | ~known_tier(initial_tier(), tiers)
    return datasets.filter((F.size("history") > 0) & bad).select(
        "dataset_id", current_tier().alias("current_backend"), initial_tier().alias("initial_backend")
    )


def dataset_costs(datasets: DataFrame, tiers=TIERS) -> DataFrame:
    """Cost of each dataset at its initial and at its current tier."""
    return with_windows(datasets).select(
        "dataset_id",
        initial_tier().alias("initial_backend"),
        current_tier().alias("current_backend"),
        cost_on(initial_tier(), tiers).alias("initial_cost"),
        cost_on(current_tier(), tiers).alias("current_cost"),
    )


def _totals(datasets: DataFrame, tiers=TIERS) -> DataFrame:
    """Sums over the datasets that can be priced at both tiers, and how many cannot: ``b``, ``o``,
    ``unpriced_datasets``. A dataset never counts on one side alone."""
    both = F.col("initial_cost").isNotNull() & F.col("current_cost").isNotNull()
    add = lambda c: F.coalesce(F.sum(F.when(both, F.col(c))), F.lit(0.0))
    return dataset_costs(datasets, tiers).agg(
        add("initial_cost").alias("b"), add("current_cost").alias("o"), F.count_if(~both).alias("unpriced_datasets")
    )


def baseline_cost(datasets: DataFrame, tiers=TIERS) -> DataFrame:
    return _totals(datasets, tiers).select(F.col("b").alias("baseline"), "unpriced_datasets")


def _moves(jobs: DataFrame) -> Column:
    return jobs.agg(F.count_if(F.col("status") == "COMPLETE")).scalar()


def optimized_cost(datasets: DataFrame, jobs: DataFrame, tiers=TIERS, fee: float = LIVE_MOVE_FEE) -> DataFrame:
    return _totals(datasets, tiers).withColumn("migration_cost", _moves(jobs) * F.lit(fee)).select(
        (F.col("o") + F.col("migration_cost")).alias("optimized"), "migration_cost", "unpriced_datasets"
    )


def cost_summary(datasets: DataFrame, jobs: DataFrame, tiers=TIERS, fee: float = LIVE_MOVE_FEE) -> DataFrame:
    """Five totals in one row, rounded to cents, and the number of datasets that are in none of them because a tier of
    theirs has no price. Each table is scanned once."""
    return _totals(datasets, tiers).withColumn("m", _moves(jobs) * F.lit(fee)).select(*summary_columns())


def summary_columns() -> list[Column]:
    """The summary from columns with the sums ``b``, ``o``, ``m`` and ``unpriced_datasets``."""
    b, opt = F.col("b"), F.col("o") + F.col("m")
    return [
        F.round(b, 2).alias("baseline"), F.round(opt, 2).alias("optimized"), F.round("m", 2).alias("migration_cost"),
        F.round(b - opt, 2).alias("savings"), F.round(percent(b - opt, b), 2).alias("savings_percent"),
        F.col("unpriced_datasets"),
    ]
