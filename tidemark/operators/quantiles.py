"""Quantiles without one task that sees the whole column: exact ones of a column, and sketches per group that merge.

The column becomes pairs (value, count), cut into ranges of values. Counts per range, one small number for each partition,
tell how many values lie before a range; running counts inside each range do the rest. The source is read once and the
stored pairs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..sources.files import staged


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Stored ``(x, c, part)``: every value with its count and the number of its range; ranges ascend."""
    x = df.select(F.col(column).cast("double").alias("x")).filter("x is not null")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = x.groupBy("x").agg(F.count("*").alias("c"))
    return staged(pairs.repartitionByRange(ranges, "x").withColumn("part", F.spark_partition_id()))


def _offsets(pairs: DataFrame) -> DataFrame:
    """``(range, before, n)``: values before each range and in all; a window over one small row per range."""
    sizes = pairs.groupBy("part").agg(F.sum("c").alias("c"))
    upto = F.sum("c").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    return sizes.select(F.col("part").alias("range"), (upto - F.col("c")).alias("before"), F.sum("c").over(W.partitionBy()).alias("n"))


def exact_quantile(df: DataFrame, column: str, p: float, method: str = "exclusive") -> DataFrame:
    """One row ``(n, value)``. Exclusive: linear at position p(n+1), and the maximum below 100 values.
    Inclusive: linear at position 1 + p(n-1). Nulls are ignored; no values give a null."""
    pairs = value_counts(df, column)
    n = F.col("n")
    want = F.lit(p) * (n + 1) if method == "exclusive" else 1 + F.lit(p) * (n - 1)
    want = F.greatest(F.lit(1.0), F.least(n.cast("double"), want))
    # Bounded by the number of partitions.
    placed = pairs.join(F.broadcast(_offsets(pairs)), F.col("part") == F.col("range"))
    within = F.sum("c").over(W.partitionBy("part").orderBy("x"))
    ranked = placed.select("x", "n", (F.col("before") + within).alias("upto"), want.alias("want"))
    first = F.floor("want")
    result = ranked.agg(
        F.max("n").alias("n"), F.max("x").alias("top"), F.max(F.col("want") - first).alias("part"),
        F.min(F.when(F.col("upto") >= first, F.col("x"))).alias("a"),
        F.min(F.when(F.col("upto") >= F.least(F.col("n"), first + 1), F.col("x"))).alias("b"),
    )
    value = F.col("a") + F.col("part") * (F.col("b") - F.col("a"))
    if method == "exclusive":
        value = F.when(n < 100, F.col("top")).otherwise(value)
    return result.select(F.coalesce(n, F.lit(0)).alias("n"), value.alias("value"))


#: Size of the sketches; the rank of an answer is off by at most RANK_ERROR of the rows (with 99 % confidence less than half).
SKETCH_K, RANK_ERROR = 400, 0.02


def quantile_sketches(df: DataFrame, column: str, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """``(by, sketch)``: a sketch of a few kilobytes per group, ready to be stored and merged. Sketches combine before the
    shuffle, so a hot group costs a task one sketch."""
    rows = df.filter(F.col(column).isNotNull())
    return rows.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], ranks: list[float]) -> DataFrame:
    """Quantiles of any coarser grouping of stored sketches: ``(by, n, p, value)``, a row per rank."""
    one = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    listed = "array(" + ", ".join(f"{float(p)!r}D" for p in ranks) + ")"
    answers = F.expr(f"inline(zip_with({listed}, kll_sketch_get_quantile_double(sketch, {listed}), (p, v) -> struct(p AS p, v AS value)))")
    return one.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), answers)


def rank_errors(df: DataFrame, column: str, quantiles: DataFrame, by: list[str]) -> DataFrame:
    """How far the rank of each value of ``quantiles`` is from what was asked, as a share of the rows of its group."""
    rows = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("x"))
    asked = F.broadcast(quantiles.select(*by, "p", "value"))  # a row per group and rank
    counts = rows.join(asked, by).groupBy(*by, "p").agg(
        F.count("*").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("p"), F.col("p") - F.col("upto") / F.col("n"))
    return counts.select(*by, "p", "n", off.alias("rank_error"))
