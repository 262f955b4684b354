
from __future__ import annotations

import pathlib
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracles import ORACLES
from tillroll import schemas, session
from tillroll.functions import money, shares
from tillroll.operators import clean, flatten, quality, reports
from tillroll.plans import publish, sql_reports, star_reports
from tillroll.plans.inputs import DROP, DROP_ONLY, FILL, Inputs, Variant, bucketed, from_defects, star_order_details
from tillroll.plans.loads import Loads
from tillroll.plans.report_sets import report_set
from tillroll.sinks import catalog, csv
from tillroll.sources import defects, files, star, tables

try:
    import corpus_pipeline
    from tillroll.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tillroll.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Top customers by completed spend."""
    return _top_customers(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        # Inputs with planted defects, and their cleaning.
        "customers_dirty": defects.customers,
        "products_dirty": defects.products,
        "orders_dirty": defects.orders,
        "customers_clean_fill": lambda spark, d: clean.customers(defects.customers(spark, d)),
        "products_clean_fill": lambda spark, d: clean.products(defects.products(spark, d)),
        "orders_clean_fill": lambda spark, d: clean.orders(defects.orders(spark, d)),
        "orders_clean_drop": lambda spark, d: clean.orders(defects.orders(spark, d), "drop"),
        # Flattening.
        "order_details": star_order_details,
        "order_details_fill": lambda spark, d: from_defects(spark, d, FILL).order_details(),
        "order_details_drop": lambda spark, d: from_defects(spark, d, DROP).order_details(),
        "order_details_drop_nofill": lambda spark, d: from_defects(spark, d, DROP_ONLY).order_details(),
        "order_details_salted": lambda spark, d: from_defects(spark, d, FILL).order_details(hot_share=1 / 1_000),
        # Reports over clean inputs.
        "top_customers": _top_customers,
        "monthly_revenue": lambda spark, d: reports.monthly_revenue(star.order_sums(spark, d)),
        "monthly_revenue_ym": lambda spark, d: reports.monthly_revenue(
            star.order_sums(spark, d), year_and_month=True, digits=None
        ),
        "monthly_revenue_recent": lambda spark, d: _recent_revenue(spark, d, days=180),
        "monthly_revenue_six_months": lambda spark, d: _recent_revenue(spark, d, months=6),
        "popular_categories": _popular_categories,
        "popular_categories_top": lambda spark, d: _popular_categories(spark, d, k=5),
        "order_status": lambda spark, d: reports.order_status(star.order_sums(spark, d), percentage=False),
        "order_status_pct": lambda spark, d: reports.order_status(star.order_sums(spark, d)),
        # Reports with defects filled by defaults.
        "top_customers_fill": lambda spark, d: from_defects(spark, d, FILL).top_customers(),
        "top_customers_all": lambda spark, d: from_defects(spark, d, FILL).top_customers(k=None),
        "top_customers_by_id": lambda spark, d: from_defects(spark, d, FILL).top_customers(k=None, by_id=True),
        "monthly_revenue_fill": lambda spark, d: reports.monthly_revenue(from_defects(spark, d, FILL).orders),
        "popular_categories_fill": lambda spark, d: from_defects(spark, d, FILL).popular_categories(),
        "order_status_fill": lambda spark, d: reports.order_status(
            from_defects(spark, d, FILL).orders, percentage=False
        ),
        # Reports as SQL text, incomplete orders dropped.
        "top_customers_sql": lambda spark, d: _sql_report(spark, d, "top_customers"),
        "top_customers_all_sql": lambda spark, d: _sql_report(spark, d, "top_customers", k=None),
        "monthly_revenue_sql": lambda spark, d: _sql_report(spark, d, "monthly_revenue"),
        "monthly_revenue_recent_sql": lambda spark, d: _sql_report(spark, d, "monthly_revenue", as_of="2001-08-01"),
        "monthly_revenue_six_months_sql": lambda spark, d: _sql_report(
            spark, d, "monthly_revenue", as_of="2001-08-01", months=6
        ),
        "popular_categories_sql": lambda spark, d: _sql_report(spark, d, "popular_categories"),
        "popular_categories_all_sql": lambda spark, d: _sql_report(spark, d, "popular_categories", k=None),
        "order_status_sql": lambda spark, d: _sql_report(spark, d, "order_status"),
        # Reports that leave unmatched keys out and do not round.
        "top_customers_unfilled": lambda spark, d: from_defects(spark, d, DROP_ONLY).top_customers(
            drop_unmatched=True, digits=None
        ),
        "monthly_revenue_ym_unfilled": lambda spark, d: reports.monthly_revenue(
            from_defects(spark, d, DROP_ONLY).orders, year_and_month=True, drop_unmatched=True, digits=None
        ),
        "popular_categories_unfilled": lambda spark, d: from_defects(spark, d, DROP_ONLY).popular_categories(
            drop_unmatched=True
        ),
        "order_status_half_even": lambda spark, d: reports.order_status(
            from_defects(spark, d, DROP_ONLY).orders, rounding=shares.HALF_EVEN, by_status=True, drop_unmatched=True
        ),
        # Quality, tables and files.
        "dq_audit": _audit,
        "table_row_counts": _table_row_counts,
        "csv_roundtrip": _csv_roundtrip,
        "table_roundtrip": lambda spark, d: _written_table(spark, d, ("overwrite", "overwrite")),
        "table_append": lambda spark, d: _written_table(spark, d, ("append", "append")),
        "table_row_counts_unfilled": lambda spark, d: _table_row_counts(spark, d, DROP_ONLY, "pandas"),
        "publish_append": lambda spark, d: _published(spark, d, mode="append"),
        "publish_recreate": lambda spark, d: _published(spark, d, recreate=True),
        "csv_one_file": _csv_one_file,
        "csv_counts": _csv_counts,
        "sql_view": _view_report,
        "revenue_fine_amounts": _fine_revenue,
        "report_set_recent": lambda spark, d: _report_set(spark, d, "recent"),
        "report_set_complete": lambda spark, d: _report_set(spark, d, "complete"),
        # Loads that run again, rows that do not fit, keys that repeat, stored layouts.
        "loads_run_twice": lambda spark, d: _loaded(spark, d).order_details().withColumn("amount", F.col("amount").cast("double")),
        "reports_after_loads": _reports_after_loads,
        "monthly_revenue_stored": _stored_revenue,
        "csv_rejects": lambda spark, d: _checked_csv(spark, d)[1].select("order_id", F.array_join("reasons", ",").alias("reasons")),
        "csv_accepted": lambda spark, d: _checked_csv(spark, d)[0],
        "dq_quarantine": _quarantine,
        "order_details_one_per_key": _one_per_key,
        "order_details_bucketed": lambda spark, d: bucketed(from_defects(spark, d, FILL), _new_database(spark), 8).order_details(),
        **_llm_queries(),
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES | (llm.ORACLES if llm else {})


def _llm_queries() -> dict[str, Query]:
    return llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {}


def _top_customers(spark: SparkSession, folder: str, **options) -> DataFrame:
    return star_reports.top_customers(star.order_sums(spark, folder), star.customers(spark, folder), **options)


def _popular_categories(spark: SparkSession, folder: str, **options) -> DataFrame:
    return star_reports.popular_categories(star.orders(spark, folder), star.products(spark, folder), **options)


def _recent_revenue(spark: SparkSession, folder: str, **window) -> DataFrame:
    recent = star.order_sums(spark, folder, since=star.window_start(spark, folder, **window))
    return reports.monthly_revenue(recent, descending=True)


def _sql_report(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    inputs = from_defects(spark, folder, DROP)
    if name in ("top_customers", "popular_categories"):
        return sql_reports.report(spark, name, inputs.sums(name), summed=True, **options)
    # The keys of the star tables are unique, so dimensions a report does not read stay out.
    return sql_reports.report(spark, name, inputs.order_details(sql_reports.COLUMNS[name], unique_keys=True), **options)


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.audit(
        defects.orders(spark, folder),
        defects.customers(spark, folder),
        defects.products(spark, folder),
        product_ids=defects.orders(spark, folder, ("product_id",)),
    )


def _new_database(spark: SparkSession) -> str:
    database, location = session.new_database(spark)
    catalog.ensure_database(spark, database, location)
    return database


def _loaded(spark: SparkSession, folder: str) -> Loads:
    """Two loads, one of which has run twice."""
    loads = Loads(spark, *session.new_database(spark))
    details = from_defects(spark, folder, FILL).order_details()
    for part in (0, 1, 1):
        loads.load(details.filter(F.col("order_id") % 2 == part), f"part-{part}")
    return loads


def _reports_after_loads(spark: SparkSession, folder: str) -> DataFrame:
    loads = _loaded(spark, folder)
    values = {
        "top_customers": ("concat_ws('/', customer_name, country)", "total_spend", {"k": None}),
        "monthly_revenue": ("month", "monthly_revenue", {}),
        "popular_categories": ("category", "order_count", {}),
        "order_status": ("status", "percentage", {}),
    }
    parts = [
        loads.report(report, **options).selectExpr(f"'{report}' AS report", f"{name} AS name", f"CAST({value} AS DOUBLE) AS value")
        for report, (name, value, options) in values.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _stored_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of the half year before the newest order, from stored months."""
    loads = _loaded(spark, folder)
    return reports.monthly_revenue(loads.order_details(loads.window_start(days=180)), descending=True)


def _checked_csv(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders written as lines, some with a number that is none, too many or too few columns, and read again."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in star.ORDER_COLUMNS]
    order = F.col("order_id")
    shown[0] = F.when(order % 37 == 0, F.concat(F.lit("#"), shown[0])).otherwise(shown[0])
    shown[4] = F.when(order % 31 == 0, F.lit("n/a")).otherwise(shown[4])
    line = F.when(order % 41 == 0, F.concat_ws(",", *shown, F.lit("late"))).when(order % 43 == 0, F.concat_ws(",", *shown[:4]))
    path = session.new_folder(spark, "lines")
    defects.orders(spark, folder).select(line.otherwise(F.concat_ws(",", *shown))).write.text(path)
    return files.read_csv_checked(spark, path, schemas.orders(T.LongType()), header=False)


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quarantine(defects.orders(spark, folder), defects.customers(spark, folder), defects.products(spark, folder))
    return found.drop("record")


def _one_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh customer and product is there again, with less said of it."""
    inputs = from_defects(spark, folder, FILL)

    def one(df: DataFrame, key: str, *blank: str) -> DataFrame:
        again = df.filter(F.col(key) % 7 == 0).withColumns({name: F.lit(None).cast("string") for name in blank})
        return clean.one_per_key(df.unionByName(again), key)

    customers = one(defects.customers(spark, folder), "customer_id", "name", "country")
    products = one(defects.products(spark, folder), "product_id", "category")
    return Inputs(defects.orders(spark, folder), customers, products, inputs.variant).order_details()


# The results of the queries below are read after they return, so what they write stays for session.cleanup().
def _table_row_counts(spark: SparkSession, folder: str, variant: Variant = FILL, style: str = "tables") -> DataFrame:
    details = from_defects(spark, folder, variant).order_details()
    return publish.to_tables(details, *session.new_database(spark), style=style)


def _published(spark: SparkSession, folder: str, **second: object) -> DataFrame:
    """The report tables after a load of the orders with an even id and one of the others."""
    database, location = session.new_database(spark)
    details = from_defects(spark, folder, FILL).order_details()
    publish.to_tables(details.filter("order_id % 2 = 0"), database, location)
    publish.to_tables(details.filter("order_id % 2 <> 0"), database, location, **second)
    keys = {
        "top_customers": ("concat_ws('/', customer_name, country)", "total_spend"),
        "monthly_revenue": ("concat_ws('/', year, month)", "monthly_revenue"),
        "popular_categories": ("category", "order_count"),
        "order_status": ("status", "order_count"),
    }
    parts = [
        spark.table(f"{database}.{name}").selectExpr(f"'{name}' AS report", f"{key} AS name", f"CAST({value} AS DOUBLE) AS value")
        for name, (key, value) in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _fine_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Unrounded sums of amounts below a millionth."""
    fine = star.orders(spark, folder, ("line_number", "status")).selectExpr("status", "line_number / 1e7D AS amount")
    return fine.groupBy("status").agg(*money.parts()).select("status", money.value(None).alias("revenue"))


def _view_report(spark: SparkSession, folder: str) -> DataFrame:
    tables.register(from_defects(spark, folder, DROP).order_details(), "shop_details")
    return tables.run_sql(spark, sql_reports.statement("popular_categories", "shop_details", k=None))


def _csv_one_file(spark: SparkSession, folder: str) -> DataFrame:
    path = session.new_folder(spark, "csv")
    csv.write_one_csv(from_defects(spark, folder, FILL).top_customers(k=None), path)
    return files.read_csv(spark, path, schemas.TOP_CUSTOMERS)


def _csv_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = session.new_folder(spark, "csv")
    paths = publish.to_csv(from_defects(spark, folder, FILL).order_details(), path, "sql", skip_empty=True)
    return files.csv_report(spark, paths)


def _report_set(spark: SparkSession, folder: str, style: str) -> DataFrame:
    """Two reports of a set, one below the other."""
    found = report_set(from_defects(spark, folder, DROP).order_details(), style, as_of="2001-08-01")
    parts = [
        found["popular_categories"].selectExpr("category AS name", "CAST(order_count AS DOUBLE) AS value"),
        found["monthly_revenue"].selectExpr("month AS name", "monthly_revenue AS value"),
    ]
    return parts[0].unionByName(parts[1])


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    details = from_defects(spark, folder, FILL).order_details()
    path = session.new_folder(spark, "csv")
    csv.write_csv(details, path)
    return files.read_csv(spark, path, details.schema)


def _written_table(spark: SparkSession, folder: str, modes: tuple[str, ...]) -> DataFrame:
    details = session.staged(from_defects(spark, folder, FILL).order_details(), "order-details")
    database, location = session.new_database(spark)
    table = f"{database}.order_details"
    catalog.ensure_database(spark, database, location)
    catalog.create_table(spark, table, schemas.table_types("order_details"))
    for mode in modes:
        catalog.write_table(details, table, mode)
    return spark.table(table).withColumn("amount", F.col("amount").cast("double"))
