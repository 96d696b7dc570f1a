"""Expressions over a history array, oldest entry first. All are row-local: no shuffle, no Python."""

from pyspark.sql import Column, functions as F

from .numeric import or_zero, whole


def known(history: Column) -> Column:
    return F.coalesce(history, F.array().cast("array<struct<timestamp:bigint,reads_1h:bigint,writes_1h:bigint,"
                                              "bytes_read_1h:bigint,hour_of_day:int,day_of_week:int>>"))


def newest(entries: Column, n) -> Column:
    """Last ``n`` entries, or all when there are fewer."""
    size = F.size(entries)
    return F.slice(entries, F.greatest(size - F.lit(n), F.lit(0)) + 1, F.lit(n))


def in_time(entries: Column) -> Column:
    """Entries by their timestamp; those of one time keep their order."""
    placed = F.transform(entries, lambda e, i: F.struct(e["timestamp"].alias("timestamp"), i.alias("place"), e.alias("entry")))
    return F.transform(F.array_sort(placed), lambda p: p["entry"])


def _sum(entries: Column, field: str) -> Column:
    # In double: exact below 2**53, and no value of an event can make it overflow.
    return F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + or_zero(e[field]).cast("double"))


def total(entries: Column, field: str) -> Column:
    return whole(_sum(entries, field))


def peak(entries: Column, field: str) -> Column:
    return F.aggregate(
        entries, F.lit(None).cast("long"), lambda acc, e: F.greatest(acc, or_zero(e[field]).cast("long"))
    )


def mean(entries: Column, field: str) -> Column:
    return _sum(entries, field) / F.size(entries)
