"""The four reports over an ``order_details`` table, or over anything with the columns they use.

Rows may come summed by a key (``sums.presum``). Every ranking ends in the group keys, so that ties have one order. Groups are
summed map-side first: a group that holds a third of the rows costs one row per
task in the shuffle.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import dates, money, shares
from tillroll.operators import sums


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == schemas.COMPLETED)


def top_customers(
    details: DataFrame,
    k: int | None = 5,
    by_id: bool = False,
    drop_unmatched: bool = False,
    digits: int | None = 2,
) -> DataFrame:
    """Completed spend per customer name and country, largest first.

    ``k=None`` returns every group. ``by_id`` keeps customers apart that share
    name and country (``details`` must then hold ``customer_id``).
    ``drop_unmatched`` leaves out groups with a null key; ``digits=None`` does
    not round.
    """
    keys = ("customer_id", "customer_name", "country") if by_id else ("customer_name", "country")
    df = _without_null_keys(completed(details), keys, drop_unmatched)
    if by_id:  # before grouping: rows cleaned earlier hold the default already
        df = df.fillna({"customer_id": schemas.ORDER_DEFAULTS["customer_id"]})
    spend = df.groupBy(*keys).agg(*sums.amounts(df)).select(*keys, money.value(digits).alias("total_spend"))
    return _limited(spend.orderBy(F.col("total_spend").desc(), *keys), k)


def monthly_revenue(
    details: DataFrame,
    year_and_month: bool = False,
    descending: bool = False,
    as_of: str | datetime.date | Column | None = None,
    days: int = 180,
    months: int | None = None,
    drop_unmatched: bool = False,
    digits: int | None = 2,
    since: str | datetime.date | Column | None = None,
) -> DataFrame:
    """Completed revenue per month, as ``yyyy-MM`` or as a year and a month number.

    With ``as_of`` (a date or a scalar column) only the ``days`` or ``months`` up to that
    date count; ``since`` gives the first day itself, for instance
    ``dates.trailing_start(df)``, which the scan can use. There is no wall clock.
    """
    df = completed(details)
    if as_of is not None:
        df = df.filter(F.col("order_date") >= dates.window_start(as_of, days, months))
    if since is not None:
        df = df.filter(F.col("order_date") >= since)
    df = _without_null_keys(df, ("order_date",), drop_unmatched)
    revenue = df.groupBy(dates.month_start("order_date").alias("_month")).agg(*sums.amounts(df))
    if year_and_month:
        keys = {"year": F.year("_month").cast("bigint"), "month": F.month("_month").cast("bigint")}
    else:
        keys = {"month": dates.month_text("_month")}
    result = revenue.select(
        *[column.alias(name) for name, column in keys.items()], money.value(digits).alias("monthly_revenue")
    )
    return result.orderBy(*[F.col(name).desc() if descending else F.col(name).asc() for name in keys])


def popular_categories(details: DataFrame, k: int | None = None, drop_unmatched: bool = False) -> DataFrame:
    """Completed orders per category, most first."""
    df = _without_null_keys(completed(details), ("category",), drop_unmatched)
    counts = df.groupBy("category").agg(sums.row_count(df).alias("order_count"))
    return _limited(counts.orderBy(F.col("order_count").desc(), "category"), k)


def order_status(
    details: DataFrame,
    percentage: bool = True,
    rounding: str = shares.HALF_UP,
    by_status: bool = False,
    drop_unmatched: bool = False,
) -> DataFrame:
    """Orders per status with their share of all orders, most first or by status name.

    The total is a sum over the grouped counts and reuses their shuffle, so the
    rows are read once.
    """
    df = _without_null_keys(details, ("status",), drop_unmatched)
    counts = df.groupBy("status").agg(sums.row_count(df).alias("order_count"))
    result = counts
    if percentage:
        total = counts.agg(F.sum("order_count")).scalar()
        result = counts.withColumn("_total", total).select(
            "status", "order_count", F.expr(shares.percent_sql("order_count", "_total", rounding)).alias("percentage")
        )
    order = [F.col("status")] if by_status else [F.col("order_count").desc(), F.col("status")]
    return result.orderBy(*order)


def _without_null_keys(df: DataFrame, keys: tuple[str, ...], drop: bool) -> DataFrame:
    for name in keys if drop else ():
        df = df.filter(F.col(name).isNotNull())
    return df


def _limited(df: DataFrame, k: int | None) -> DataFrame:
    return df if k is None else df.limit(k)
