"""Date parsing, month keys and trailing windows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_FORMAT = "yyyy-MM"


def parse(text: Column) -> Column:
    """Text to date; malformed text gives null, also in ANSI mode."""
    return text.try_cast("date")


def month_start(date: str | Column) -> Column:
    """First day of the month. Grouping on it formats once per group, not per row."""
    return F.trunc(date, "MM")


def month_text(month: str | Column) -> Column:
    return F.date_format(month, MONTH_FORMAT)


def newest(df: DataFrame, date: str = "order_date") -> Column:
    """The newest date in ``df`` as a scalar subquery: lazy, nothing is collected."""
    return df.agg(F.max(date)).scalar()


def trailing_start(df: DataFrame, date: str = "order_date", days: int = 180, months: int | None = None) -> Column:
    """First day of the window that ends at the newest date in ``df``, as a scalar subquery.

    All arithmetic is inside the subquery: a bare scalar, of the type of the column, is
    what a filter on that column can hand to the Parquet scan.
    """
    start = window_start(F.max(F.col(date).cast("date")), days, months)
    return df.agg(start.cast(df.schema[date].dataType)).scalar()


def window_start(as_of: str | datetime.date | Column, days: int = 180, months: int | None = None) -> Column:
    """First day of the trailing window that ends at ``as_of``; that day is included."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.date_sub(end, days) if months is None else F.add_months(end, -months)
