"""The three inputs, cleaned under one policy, and what follows from them.

The variants of the reports differ in how orders and dimensions are cleaned and
whether unmatched names get defaults:

=========  ===============  ==========  =================
variant    orders           dimensions  unmatched names
=========  ===============  ==========  =================
FILL       defaults         defaults    defaults
DROP       rows dropped     as read     defaults
DROP_ONLY  rows dropped     as read     null
=========  ===============  ==========  =================
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas
from tillroll.operators import clean, flatten
from tillroll.plans import star_reports
from tillroll.sinks import catalog
from tillroll.sources import defects, star


@dataclass(frozen=True)
class Variant:
    orders: str
    dimensions: str
    filled: bool


FILL = Variant("fill", "fill", True)
DROP = Variant("drop", "none", True)
DROP_ONLY = Variant("drop", "none", False)


class Inputs:
    """Orders, customers and products, cleaned as a variant says when first used."""

    def __init__(
        self,
        orders: Callable[[], DataFrame] | DataFrame,
        customers: Callable[[], DataFrame] | DataFrame,
        products: Callable[[], DataFrame] | DataFrame,
        variant: Variant = FILL,
    ) -> None:
        self._orders, self._customers, self._products = orders, customers, products
        self.variant = variant

    @cached_property
    def orders(self) -> DataFrame:
        return clean.orders(_frame(self._orders), self.variant.orders, fill_keys=False)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.customers(_frame(self._customers), self.variant.dimensions)

    @cached_property
    def products(self) -> DataFrame:
        return clean.products(_frame(self._products), self.variant.dimensions)

    def order_details(self, columns: tuple[str, ...] = flatten.COLUMNS, **options) -> DataFrame:
        """``flatten.order_details`` with its options."""
        return flatten.order_details(
            self.orders, self.customers, self.products, columns=columns, filled=self.variant.filled, **options
        )

    def top_customers(self, **options) -> DataFrame:
        """``star_reports.top_customers`` with its options."""
        return star_reports.top_customers(self.orders, self.customers, self.variant.filled, **options)

    def sums(self, report: str) -> DataFrame:
        """Completed orders summed ahead of the join that ``top_customers`` or ``popular_categories`` needs."""
        if report == "top_customers":
            return star_reports.customer_sums(self.orders, self.customers, self.variant.filled)
        return star_reports.category_sums(self.orders, self.products, self.variant.filled)

    def popular_categories(self, **options) -> DataFrame:
        """``star_reports.popular_categories`` with its options."""
        return star_reports.popular_categories(self.orders, self.products, self.variant.filled, **options)


def bucketed(inputs: Inputs, database: str, buckets: int) -> Inputs:
    """The same inputs, cleaned once, from tables that lie by the keys of the joins.

    Orders and customers then meet without a shuffle, as often as they are joined. Products have another
    key: they are broadcast where they are small, else only the joined rows are dealt to their buckets.
    """
    places = {"orders": "customer_id", "customers": "customer_id", "products": "product_id"}
    tables = [
        catalog.write_bucketed(getattr(inputs, name), f"{database}.{name}_bucketed", key, buckets)
        for name, key in places.items()
    ]
    return Inputs(*tables, Variant("none", "none", inputs.variant.filled))


def _frame(source: Callable[[], DataFrame] | DataFrame) -> DataFrame:
    return source() if callable(source) else source


def from_defects(spark: SparkSession, folder: str, variant: Variant) -> Inputs:
    """The star tables with planted defects."""
    return Inputs(
        partial(defects.orders, spark, folder),
        partial(defects.customers, spark, folder),
        partial(defects.products, spark, folder),
        variant,
    )


def star_order_details(spark: SparkSession, folder: str, columns: tuple[str, ...] = flatten.COLUMNS) -> DataFrame:
    """``order_details`` of the star tables.

    Customers are joined to the order headers, before the lines: that shuffles a
    row per order by customer id, not a row per line.
    """
    headers = flatten.with_customers(star.headers(spark, folder), star.customers(spark, folder))
    lines = star.lines(spark, folder).join(headers, "order_id", "left")
    details = flatten.with_products(lines, star.products(spark, folder))
    return clean.fill(details.select(*columns), schemas.DETAIL_DEFAULTS)
