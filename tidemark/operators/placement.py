"""Best tier for each dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import COLD_TIER, LIMITS, TIERS, WARM_TIERS, Limits
from ..functions.numeric import percent
from ..functions.once import with_columns_once
from .forecast import HOURS, with_windows
from .pricing import cost_on, current_tier, known_tier, tier_cost

DECISION = ("target_backend", "reason", "current_cost", "target_cost", "savings", "savings_percent")


def decide(stats: DataFrame, limits: Limits = LIMITS, tiers=TIERS) -> DataFrame:
    """Adds the decision to rows that carry window statistics, a size and ``current_backend``.

    Row-local: each tier is scored in its own column expression and the smallest (cost, position) wins, so the
    operator needs neither a join nor a shuffle. Rows with history on an unknown tier are left out.
    """
    peak, avg = F.col("peak_reads"), F.col("avg_reads")
    per_hour = F.when(F.col("fc_reads") != 0, F.col("fc_reads") / HOURS).otherwise(avg)
    hot = F.col("hot")
    cold = F.col("cold")

    def allowed(tier) -> Column:
        fast = F.lit(tier.latency <= limits.fast_latency)
        return F.when(hot, fast).when(cold, F.lit(True)).otherwise(F.lit(tier.name in WARM_TIERS))

    scores = F.array(*[
        F.when(
            allowed(t),
            F.struct(
                tier_cost(t, ~cold).alias("cost"), F.lit(i).alias("ord"), F.lit(t.name).alias("backend")
            ),
        )
        for i, t in enumerate(tiers)
    ])
    judged = (
        stats.withColumn("here", current_tier())
        .filter((F.col("n") == 0) | known_tier(F.col("here"), tiers))
        .withColumns({
            "cold": (avg <= limits.cold_reads) & (peak < limits.hot_reads),
            "hot": (peak >= limits.hot_reads) | (per_hour >= limits.hot_reads),
        })
    )
    judged = (
        with_columns_once(judged, {"best": F.array_min(scores), "cost_here": cost_on(F.col("here"), tiers, ~cold)})
        .withColumn("gain", F.col("cost_here") - F.col("best.cost"))
        .withColumn("gain_percent", percent(F.col("gain"), F.col("cost_here")))
    )
    empty = F.col("n") == 0
    hold = (
        (F.col("best.backend") != F.col("here"))
        & (F.col("gain") < limits.min_savings)
        & (F.col("gain_percent") < limits.min_savings_percent)
    )
    stay = empty | hold
    zero = F.lit(0.0)
    reason = (
        F.when(empty, "insufficient-history")
        .when(hold, "hysteresis-hold")
        .when(F.col("best.backend") == COLD_TIER, "cold-data-cooldown")
        .when(peak >= limits.hot_reads, "hot-read-low-latency")
        .otherwise("forecasted-cost-reduction")
    )
    here = F.col("cost_here")
    return with_columns_once(judged, {
        "target_backend": F.when(stay, F.col("here")).otherwise(F.col("best.backend")),
        "reason": reason,
        "current_cost": F.when(empty, zero).when(hold, here).otherwise(F.round(here, 4)),
        "target_cost": F.when(empty, zero).when(hold, here).otherwise(F.round("best.cost", 4)),
        "savings": F.when(stay, zero).otherwise(F.round("gain", 4)),
        "savings_percent": F.when(stay, zero).otherwise(F.round("gain_percent", 2)),
    }).drop("here", "cold", "hot", "best", "cost_here", "gain", "gain_percent")


def evaluate_placement(datasets: DataFrame, limits: Limits = LIMITS, tiers=TIERS) -> DataFrame:
    """One decision per dataset."""
    return decide(with_windows(datasets), limits, tiers).select("dataset_id", "current_backend", *DECISION)


def choose_best_backend(datasets: DataFrame, limits: Limits = LIMITS, tiers=TIERS) -> DataFrame:
    return evaluate_placement(datasets, limits, tiers).select("dataset_id", "target_backend", "reason")


def should_migrate(current: Column, target: Column) -> Column:
    """True when the tiers differ; a missing current tier differs from any target."""
    return ~current.eqNullSafe(target)
