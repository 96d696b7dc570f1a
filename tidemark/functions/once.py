"""Columns that are computed once per row.

Spark copies an expression into every filter and projection above that uses it. That is right for cheap
expressions and costly for parsing. The one-row generator below is a boundary that later filters do not cross.
"""

from pyspark.sql import Column, DataFrame, functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
