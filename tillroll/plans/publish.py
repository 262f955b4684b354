"""Load ``order_details`` and the four reports into tables or CSV folders.

``order_details`` is staged first and everything is computed from what was staged,
so the cleaning and the joins run once, and a lost executor never sets the run
back behind it. Reports cover the rows of this load: with ``append`` they come
beside those of earlier loads. Each result is replaced or appended by itself:
plain Spark has no transaction across tables.
"""

from __future__ import annotations

import datetime
import posixpath

from pyspark.sql import Column, DataFrame

from tillroll import schemas, session
from tillroll.functions import shares
from tillroll.operators import quality, reports
from tillroll.plans.report_sets import report_set
from tillroll.sinks import catalog, csv


TABLE_STYLES = ("tables", "pandas")


def table_reports(details: DataFrame, style: str = "tables") -> dict[str, DataFrame]:
    """The reports in the shape of the output tables: year and month, percent to even.

    ``tables`` keeps groups with a null key and rounds money half-up; ``pandas`` leaves
    such groups out and sums money unrounded.
    """
    if style not in TABLE_STYLES:
        raise ValueError(f"style must be one of {TABLE_STYLES}, not {style!r}")
    if style == "pandas":
        return report_set(details, "pandas")
    return {
        "top_customers": reports.top_customers(details),
        "monthly_revenue": reports.monthly_revenue(details, year_and_month=True),
        "popular_categories": reports.popular_categories(details),
        "order_status": reports.order_status(details, rounding=shares.HALF_EVEN, by_status=True),
    }


def to_tables(
    details: DataFrame,
    database: str,
    location: str | None = None,
    mode: str = "overwrite",
    wide: bool = True,
    recreate: bool = False,
    style: str = "tables",
) -> DataFrame:
    """Write all five tables and return their row counts.

    ``recreate`` drops the tables first; ``style`` as in ``table_reports``.
    """
    spark = details.sparkSession
    catalog.ensure_database(spark, database, location)
    catalog.create_tables(spark, database, wide=wide, recreate=recreate)
    with session.temporary(details, "order-details") as staged:
        for name, df in {"order_details": staged, **table_reports(staged, style)}.items():
            catalog.write_table(df, f"{database}.{name}", mode)
    return quality.table_row_counts(spark, database)


def to_csv(
    details: DataFrame,
    folder: str,
    style: str = "dataframe",
    as_of: str | datetime.date | Column | None = None,
    skip_empty: bool = False,
    one_file: bool = False,
) -> dict[str, str]:
    """Write all five results as CSV folders and return their paths.

    The details are staged as Parquet in the shared folder: the reports then read
    only their columns of it, which CSV would not allow. ``one_file`` writes each
    report, not the details, as one file in the report's order.
    """
    paths = {name: posixpath.join(folder, name) for name in schemas.OUTPUT_TABLES}
    with session.temporary(details, "order-details") as staged:
        csv.write_csv(staged, paths["order_details"], skip_empty=skip_empty)
        for name, df in report_set(staged, style, as_of).items():
            if one_file:
                csv.write_one_csv(df, paths[name])
            else:
                csv.write_csv(df, paths[name], skip_empty=skip_empty)
    return paths
