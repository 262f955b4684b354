"""The four reports as SQL text over a view or table ``order_details``.

Run one with ``report(spark, name, details)``, or register the details and put
the text of ``statement`` through ``spark.sql``.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions import money, shares
from tillroll.operators import sums
from tillroll.sources import tables

# The columns of order_details that each report reads.
COLUMNS = {
    "top_customers": ("customer_name", "country", "amount", "status"),
    "monthly_revenue": ("amount", "status", "order_date"),
    "popular_categories": ("category", "status"),
    "order_status": ("status",),
}


def statement(
    name: str,
    source: str = "order_details",
    k: int | None = 5,
    as_of: str | datetime.date | None = None,
    days: int = 180,
    months: int | None = None,
    summed: bool = False,
) -> str:
    """SQL text of a report over the table or view ``source``.

    With ``summed`` the source holds sums per customer or product (``sums.presum``, or
    ``Inputs.sums``) in place of orders: customer and category reports then join a row
    per key, not a row per order.

    ``k`` limits customers and categories; ``as_of`` with ``days`` or ``months``
    limits revenue to a trailing window, as in ``reports``.
    """
    limit = "" if k is None else f" LIMIT {int(k)}"
    money_sum, row_count = (money.merged_sql(), f"sum({sums.ROWS})") if summed else (money.total_sql(), "count(*)")
    window = ""
    if as_of is not None:
        end = f"DATE '{datetime.date.fromisoformat(str(as_of)).isoformat()}'"
        start = f"date_sub({end}, {int(days)})" if months is None else f"add_months({end}, -{int(months)})"
        window = f" AND order_date >= {start}"
    texts = {
        "top_customers": f"""
            SELECT customer_name, country, {money_sum} AS total_spend
            FROM {source} WHERE status = 'completed'
            GROUP BY customer_name, country
            ORDER BY total_spend DESC, customer_name, country{limit}""",
        "monthly_revenue": f"""
            SELECT date_format(month_start, 'yyyy-MM') AS month, monthly_revenue
            FROM (SELECT trunc(order_date, 'MM') AS month_start, {money_sum} AS monthly_revenue
                  FROM {source} WHERE status = 'completed'{window}
                  GROUP BY trunc(order_date, 'MM'))
            ORDER BY month DESC""",
        "popular_categories": f"""
            SELECT category, {row_count} AS order_count
            FROM {source} WHERE status = 'completed'
            GROUP BY category
            ORDER BY order_count DESC, category{limit}""",
        "order_status": f"""
            WITH counts AS (SELECT status, {row_count} AS order_count FROM {source} GROUP BY status)
            SELECT status, order_count, {shares.percent_sql("order_count", "total")} AS percentage
            FROM (SELECT status, order_count, (SELECT sum(order_count) FROM counts) AS total FROM counts)
            ORDER BY order_count DESC, status""",
    }
    return texts[name]


def report(spark: SparkSession, name: str, details: DataFrame, **options) -> DataFrame:
    """Run a report over a DataFrame, without leaving a view behind; options as in ``statement``."""
    return tables.run_sql(spark, statement(name, "{details}", **options), details=details)
