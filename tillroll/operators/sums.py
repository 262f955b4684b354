"""Summing rows by a key ahead of a join or a report.

Reports need only the sum of amounts and the number of rows per group. Summed by
a join key first, with map-side sums, a table meets the join with one row per
key, so its shuffle carries a row per key and task and a hot key is one row.
Reports take such a table in place of rows; the columns tell them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money

ROWS = "order_rows"


def row_count(df: DataFrame) -> Column:
    return (F.sum(ROWS) if ROWS in df.columns else F.count("*")).alias(ROWS)


def amounts(df: DataFrame, amount: str = "amount") -> list[Column]:
    return money.merged() if money.UNITS in df.columns else money.parts(amount)


def presum(df: DataFrame, *keys: str, amount: str = "amount") -> DataFrame:
    """One row per key with the sums; Catalyst drops those a report does not read."""
    return df.groupBy(*keys).agg(*amounts(df, amount), row_count(df))
