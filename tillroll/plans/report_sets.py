"""The four reports together, in each of the ways they are asked for.

===========  ==============  ===================  ============  =====================
style        customers       revenue              categories    status
===========  ==============  ===================  ============  =====================
dataframe    top 5           month, ascending     all           counts
sql          top 5           month, descending    top 5         counts and percent
pandas       top 5, exact    year and month       all           percent to even, by name
recent       top 5           last 180 days        top 5         counts and percent
complete     all             last six months      all           counts and percent
===========  ==============  ===================  ============  =====================

``pandas`` leaves out groups with a null key and does not round money, as pandas
grouping does; the others keep null groups and round half-up.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame

from tillroll.functions import shares
from tillroll.operators import reports

STYLES = ("dataframe", "sql", "pandas", "recent", "complete")


def report_set(
    details: DataFrame, style: str = "dataframe", as_of: str | datetime.date | Column | None = None
) -> dict[str, DataFrame]:
    """Name to report. ``recent`` and ``complete`` need ``as_of``, the end of their window."""
    if style not in STYLES:
        raise ValueError(f"style must be one of {STYLES}, not {style!r}")
    if style in ("recent", "complete") and as_of is None:
        raise ValueError(f"style {style!r} needs as_of")
    exact = {"drop_unmatched": True, "digits": None}
    top_customers, monthly_revenue, popular_categories, order_status = {
        "dataframe": ({}, {}, {}, {"percentage": False}),
        "sql": ({}, {"descending": True}, {"k": 5}, {}),
        "pandas": (
            exact,
            {"year_and_month": True, **exact},
            {"drop_unmatched": True},
            {"rounding": shares.HALF_EVEN, "by_status": True, "drop_unmatched": True},
        ),
        "recent": ({}, {"descending": True, "as_of": as_of}, {"k": 5}, {}),
        "complete": ({"k": None}, {"descending": True, "as_of": as_of, "months": 6}, {}, {}),
    }[style]
    return {
        "top_customers": reports.top_customers(details, **top_customers),
        "monthly_revenue": reports.monthly_revenue(details, **monthly_revenue),
        "popular_categories": reports.popular_categories(details, **popular_categories),
        "order_status": reports.order_status(details, **order_status),
    }
