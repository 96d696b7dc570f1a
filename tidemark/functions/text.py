"""Identifiers, job reasons and report text."""

from pyspark.sql import Column, functions as F


def dataset_key(number: Column) -> Column:
    """``ds_`` and at least six digits; longer numbers keep all their digits."""
    return F.format_string("ds_%06d", number.cast("long"))


def short_number(x: Column, places: int = 4) -> Column:
    """Shortest plain decimal text of a value already rounded to ``places``: 12.0, 0.0009, 12345678.9."""
    fixed = x.cast(f"decimal(38,{places})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def scheduled_reason(reason: Column, savings: Column, savings_percent: Column) -> Column:
    return F.concat(
        reason, F.lit(": save $"), short_number(savings), F.lit("/day ("), short_number(savings_percent, 2), F.lit("%)")
    )


def live_reason(reason: Column) -> Column:
    return F.concat(F.lit("real-time-hot-read: "), reason)


def dollars(x: Column) -> Column:
    return F.format_string("$%.2f", x)


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)
