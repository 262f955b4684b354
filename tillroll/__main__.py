"""Run the whole job over a folder with customers.csv, products.csv and orders.csv.

    spark-submit tillroll/__main__.py INPUT --csv OUTPUT [--variant fill] [--style dataframe]
    python -m tillroll INPUT --database shop [--variant drop]
"""

from __future__ import annotations

import argparse
import pathlib
import sys

if __package__ in (None, ""):  # started by path, as spark-submit does
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from tillroll import session
from tillroll.plans import publish
from tillroll.plans.inputs import DROP, DROP_ONLY, FILL, Inputs
from tillroll.plans.report_sets import STYLES
from tillroll.sources import files

VARIANTS = {"fill": FILL, "drop": DROP, "drop-only": DROP_ONLY}


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillroll", description="Clean, join and report on orders.")
    parser.add_argument("input", help="folder with customers.csv, products.csv and orders.csv")
    parser.add_argument("--csv", help="folder for CSV results")
    parser.add_argument("--database", help="database for result tables")
    parser.add_argument("--variant", choices=VARIANTS, default="fill", help="how incomplete rows are treated")
    parser.add_argument("--style", choices=STYLES, default="dataframe", help="which form of the reports goes to CSV")
    parser.add_argument("--as-of", help="end of the window of the styles recent and complete, yyyy-mm-dd")
    parser.add_argument("--append", action="store_true", help="add to the tables instead of replacing their rows")
    parser.add_argument("--recreate", action="store_true", help="drop the tables first")
    parser.add_argument("--narrow", action="store_true", help="declare INT and DECIMAL(10,2) instead of wider types")
    parser.add_argument("--table-style", choices=publish.TABLE_STYLES, default="tables", help="form of the report tables")
    parser.add_argument("--one-file", action="store_true", help="write each report to CSV as one file")
    options = parser.parse_args(arguments)
    if not (options.csv or options.database):
        parser.error("give --csv, --database or both")
    return options


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    customers, products, orders = files.read_inputs(spark, options.input)
    details = Inputs(orders, customers, products, VARIANTS[options.variant]).order_details()
    if options.csv:
        paths = publish.to_csv(details, options.csv, options.style, options.as_of, one_file=options.one_file)
        files.csv_report(spark, paths).show(truncate=False)
    if options.database:
        mode = "append" if options.append else "overwrite"
        counts = publish.to_tables(
            details,
            options.database,
            mode=mode,
            wide=not options.narrow,
            recreate=options.recreate,
            style=options.table_style,
        )
        counts.show(truncate=False)


if __name__ == "__main__":
    run(session.build_session(), parse(sys.argv[1:]))
