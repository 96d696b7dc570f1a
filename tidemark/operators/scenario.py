"""Demand calendar and workload templates next to observed access, and hourly rows without gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import CALENDAR, CYCLE_DAYS, PERSONAS
from ..functions.numeric import whole

def calendar_table(spark: SparkSession, entries=CALENDAR) -> DataFrame:
    rows = [
        (e.name, e.start_day, e.duration_days, list(e.personas), e.read_multiplier, e.write_multiplier) for e in entries
    ]
    return spark.createDataFrame(
        rows,
        "name string, start_day int, duration_days int, personas array<string>, read_multiplier double, "
        "write_multiplier double",
    )


def persona_table(spark: SparkSession, personas=PERSONAS) -> DataFrame:
    return spark.createDataFrame(
        [(p.name, p.initial_backend, float(p.base_reads), float(p.base_writes)) for p in personas],
        "persona string, template_backend string, base_reads double, base_writes double",
    )


def daily_multipliers(calendar: DataFrame, cycle_days: int = CYCLE_DAYS) -> DataFrame:
    """Product of the multipliers in force per persona and day of the cycle.

    The date ranges become single days, so the lookup is an equality join on at most personas x cycle days rows.
    """
    # An entry of no days covers none; a sequence would count down.
    days = calendar.filter("duration_days > 0").select(
        F.explode(F.sequence("start_day", F.col("start_day") + F.col("duration_days") - 1)).alias("cycle_day"),
        "personas", "read_multiplier", "write_multiplier",
    ).filter(F.col("cycle_day").between(0, cycle_days - 1))
    one = F.lit(1.0)
    return (
        days.withColumn("persona", F.explode("personas"))
        .groupBy("persona", "cycle_day")
        .agg(
            F.product(F.coalesce("read_multiplier", one)).alias("read_multiplier"),
            F.product(F.coalesce("write_multiplier", one)).alias("write_multiplier"),
        )
    )


def calendar_access(access: DataFrame, calendar: DataFrame | None = None, cycle_days: int = CYCLE_DAYS,
                    personas=PERSONAS) -> DataFrame:
    """Observed hourly rows (``dataset_id, persona, timestamp, reads_1h, writes_1h``) with the multipliers in force for
    their persona on their day of the cycle (1.0 when there is none) and the template rates of the persona (null when
    unknown)."""
    spark = access.sparkSession
    calendar = calendar_table(spark) if calendar is None else calendar
    day = F.pmod(F.floor(F.col("timestamp") / 86400), F.lit(cycle_days)).cast("int")
    rows = access.select("dataset_id", "persona", "timestamp", "reads_1h", "writes_1h", day.alias("cycle_day"))
    # Both sides are bounded: one row per template, and at most templates x cycle days.
    names = [p.name for p in personas]
    lookup = daily_multipliers(calendar, cycle_days).filter(F.col("persona").isin(*names))
    joined = rows.join(F.broadcast(lookup), ["persona", "cycle_day"], "left").join(
        F.broadcast(persona_table(spark, personas).drop("template_backend")), "persona", "left"
    )
    one = F.lit(1.0)
    return joined.withColumns({
        "in_entry": F.col("read_multiplier").isNotNull(), "read_multiplier": F.coalesce("read_multiplier", one),
        "write_multiplier": F.coalesce("write_multiplier", one),
    })


def calendar_effect(access: DataFrame, calendar: DataFrame | None = None, **options) -> DataFrame:
    """Mean reads per dataset inside and outside the entries of the calendar, next to what was expected of them."""
    inside = F.col("in_entry")
    mean = lambda when: F.avg(F.when(when, F.col("reads_1h").cast("double")))
    return calendar_access(access, calendar, **options).groupBy("dataset_id", "persona").agg(
        F.count_if(inside).alias("hours_inside"), F.count_if(~inside).alias("hours_outside"),
        mean(inside).alias("reads_inside"), mean(~inside).alias("reads_outside"),
        F.max("read_multiplier").alias("expected_multiplier"), F.max("base_reads").alias("template_reads"),
    )


#: Whole hours that the grid covers, in epoch seconds: the years 1970 to 2099.
FIRST_SECOND, LAST_SECOND = 0, 4_102_444_799


def fill_hours(access: DataFrame) -> DataFrame:
    """Hourly rows with the missing hours between the first and last row of each dataset as zeros. Rows are added up to
    whole hours first, so none is lost; rows outside ``FIRST_SECOND`` to ``LAST_SECOND`` keep their hour but do not
    stretch the grid."""
    hour = F.floor(F.col("timestamp") / 3600) * 3600
    sums = [whole(F.sum(F.col(c).cast("double"))).alias(c) for c in ("reads_1h", "writes_1h", "bytes_read_1h")]
    values = access.groupBy("dataset_id", hour.cast("long").alias("timestamp")).agg(*sums)
    usual = F.col("timestamp").between(FIRST_SECOND, LAST_SECOND)
    span = values.filter(usual).groupBy("dataset_id").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    grid = span.select("dataset_id", F.explode(F.sequence("first", "last", F.lit(3600).cast("long"))).alias("timestamp"))
    # A full join also keeps the hours that lie outside the grid.
    joined = grid.join(values, ["dataset_id", "timestamp"], "full")
    zero = F.lit(0).cast("long")
    return joined.select(
        "dataset_id", "timestamp",
        *[F.coalesce(c, zero).alias(c) for c in ("reads_1h", "writes_1h", "bytes_read_1h")],
        F.pmod(F.floor(F.col("timestamp") / 3600), F.lit(24)).cast("int").alias("hour_of_day"),
        F.pmod(F.floor(F.col("timestamp") / 86400) + 3, F.lit(7)).cast("int").alias("day_of_week"),
    )
