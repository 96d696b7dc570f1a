"""Ordered per-key work that stays parallel when one key holds a large share of the rows.

A window over a key sends all rows of that key to one task. ``spread`` cuts the key into blocks of
consecutive rows and copies the few rows a frame needs across the cut, so that a window over
(key, block) gives the same answer with a bounded task size. Only keys above a size limit are cut.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from ..functions.once import with_columns_once
from ..sources.files import staged

MIN_BLOCK_ROWS = 100_000


def hot_blocks(
    df: DataFrame, key: str, bucket: Column, lookback: int, lookahead: int, min_rows: int = MIN_BLOCK_ROWS
) -> DataFrame:
    """One row per bucket of a key with more than ``min_rows`` rows: its block, of about so many rows, and the first and
    last block whose frames may reach into it.

    ``bucket`` is a non-decreasing function of the order. Each bucket holds at least one row, hence ``lookback`` buckets
    hold at least ``lookback`` rows. One window goes over the buckets of a key, so they should be much fewer than its
    rows: days for hourly rows, ranges of arrival numbers for events.
    """
    counts = df.groupBy(key, bucket.alias("b")).agg(F.count("*").alias("n"))
    per_key = W.partitionBy(key)
    in_order = per_key.orderBy("b")
    placed = (
        counts.withColumn("key_rows", F.sum("n").over(per_key)).filter(F.col("key_rows") > min_rows)
        .withColumn("block", F.floor((F.sum("n").over(in_order) - F.col("n")) / min_rows))
    )
    return placed.select(
        F.col(key).alias("hot_key"), F.col("b").alias("hot_b"), "block",
        F.coalesce(F.lag("block", lookahead).over(in_order), F.min("block").over(per_key)).alias("first_block"),
        F.coalesce(F.lead("block", lookback).over(in_order), F.max("block").over(per_key)).alias("last_block"),
    )


@dataclass(frozen=True)
class Runs:
    """Rows spread over (key, block), the window that walks them, and the columns to keep at the end."""

    df: DataFrame
    window: WindowSpec
    own: str = "run_own"
    block: str = "run_block"

    def with_columns(self, **columns: Column) -> "Runs":
        return replace(self, df=self.df.withColumns(columns))

    def done(self) -> DataFrame:
        """Drop the copied rows and the helper columns."""
        return self.df.filter(self.own).drop(self.own, self.block)


def spread(
    df: DataFrame, key: str, order: list, bucket: Column, lookback: int = 0, lookahead: int = 0,
    min_rows: int = MIN_BLOCK_ROWS, largest: int | None = None,
) -> Runs:
    """Prepare ``df`` for windows over ``key`` in ``order`` whose frames reach at most ``lookback`` rows back and
    ``lookahead`` rows ahead. ``bucket`` is a non-decreasing function of the order with few rows per key and value.
    ``largest``, where it is known, is a bound on the rows of a key; if it is small, nothing has to be counted."""
    if largest is not None and largest <= min_rows:
        whole = df.select("*", F.lit(0).cast("long").alias("run_block"), F.lit(True).alias("run_own"))
        return Runs(whole, W.partitionBy(key, "run_block").orderBy(*order))
    # Stored, so that its size is known when the join is planned; mostly it is empty.
    hot = staged(hot_blocks(df, key, bucket, lookback, lookahead, min_rows))
    columns = df.columns
    rows = with_columns_once(df, {"run_b": bucket})
    joined = rows.join(hot, (rows[key] == F.col("hot_key")) & (F.col("run_b") == F.col("hot_b")), "left")
    mine = F.coalesce("block", F.lit(0)).cast("long")
    # A bucket at a border is doubled, once for each block that looks across; all others stay as they are.
    blocks = F.sequence(F.coalesce("first_block", F.lit(0)).cast("long"), F.coalesce("last_block", F.lit(0)).cast("long"))
    out = joined.select(*columns, mine.alias("run_mine"), F.explode(blocks).alias("run_block"))
    out = out.withColumn("run_own", F.col("run_block") == F.col("run_mine")).drop("run_mine")
    return Runs(out, W.partitionBy(key, "run_block").orderBy(*order))


def positions(df: DataFrame, key: str, order: list, bucket: Column) -> DataFrame:
    """Adds ``pos`` (0-based row position within the key) and ``key_rows``.

    Rows are numbered within (key, bucket) and shifted by the bucket counts before, so no task sees more
    than one bucket of a key's rows.
    """
    per_key = W.partitionBy(key)
    counts = df.groupBy(key, bucket.alias("pos_b")).agg(F.count("*").alias("n"))
    before = counts.select(
        F.col(key).alias("pos_key"), "pos_b",
        (F.sum("n").over(per_key.orderBy("pos_b")) - F.col("n")).alias("pos_before"),
        F.sum("n").over(per_key).alias("key_rows"),
    )
    rows = df.withColumn("pos_row_b", bucket)
    joined = rows.join(before, (rows[key] == F.col("pos_key")) & (F.col("pos_row_b") == F.col("pos_b")))
    local = F.row_number().over(W.partitionBy(key, "pos_row_b").orderBy(*order)) - 1
    return joined.withColumn("pos", F.col("pos_before") + local).drop("pos_key", "pos_b", "pos_row_b", "pos_before")
