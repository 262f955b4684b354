"""Customer and category reports straight from the inputs.

The completed orders are summed per customer or product id before they are
joined. Sums survive the fan-out of a repeated dimension key, so the results
equal those over ``order_details`` as long as the *other* dimension, which is
not read here, has unique keys.

Revenue per month and orders per status need no dimension: call
``reports.monthly_revenue`` and ``reports.order_status`` on the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators import clean, flatten, reports, sums


def top_customers(orders: DataFrame, customers: DataFrame, filled: bool = True, **options) -> DataFrame:
    """``reports.top_customers`` with its options."""
    return reports.top_customers(customer_sums(orders, customers, filled), **options)


def popular_categories(orders: DataFrame, products: DataFrame, filled: bool = True, **options) -> DataFrame:
    """``reports.popular_categories`` with its options."""
    return reports.popular_categories(category_sums(orders, products, filled), **options)


def customer_sums(orders: DataFrame, customers: DataFrame, filled: bool = True) -> DataFrame:
    """Completed orders summed per customer id, with name and country; for reports and SQL text."""
    return _filled(flatten.with_customers(_completed_sums(orders, "customer_id"), customers), filled)


def category_sums(orders: DataFrame, products: DataFrame, filled: bool = True) -> DataFrame:
    """Completed orders summed per product id, with the category."""
    return _filled(flatten.with_products(_completed_sums(orders, "product_id"), products, ("category",)), filled)


def _completed_sums(orders: DataFrame, key: str) -> DataFrame:
    summed = sums.presum(reports.completed(orders), key)
    return summed.withColumn("status", F.lit(schemas.COMPLETED))


def _filled(df: DataFrame, filled: bool) -> DataFrame:
    return clean.fill(df, schemas.DETAIL_DEFAULTS) if filled else df
