from __future__ import annotations

import datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillroll.functions import dates, shares
from tillroll.operators import reports, sums
from tillroll.plans import sql_reports
from tillroll.plans.report_sets import STYLES, report_set
from tillroll.plans.inputs import DROP, DROP_ONLY, FILL, Inputs


def day(text):
    return datetime.date.fromisoformat(text)


DETAILS = [
    (1, "Ann", "UK", "Pen", "Office", 10.10, "completed", day("2024-01-02")),
    (2, "Ann", "UK", "Ink", "Office", 0.20, "completed", day("2024-01-31")),
    (3, "Bob", "USA", "Ball", "Sports", 10.30, "completed", day("2024-03-05")),
    (4, "Ann", "USA", "Ball", "Sports", 10.30, "completed", day("2024-03-06")),
    (5, "Cem", "UK", "Book", "Books", 99.00, "pending", day("2024-04-01")),
    (6, None, None, None, None, 7.005, "completed", None),
    (7, "Dan", "UK", "Pen", "Office", 1.00, "cancelled", day("2024-06-30")),
    (8, "Dan", "UK", "Pen", "Office", 1.00, "Completed", day("2024-06-30")),
]


@pytest.fixture
def details(make):
    return make("details", DETAILS)


def test_top_customers(details):
    assert rows(reports.top_customers(details)) == [
        ("Ann", "UK", 10.3),
        ("Ann", "USA", 10.3),
        ("Bob", "USA", 10.3),
        (None, None, 7.01),
    ]
    assert rows(reports.top_customers(details, k=2)) == [("Ann", "UK", 10.3), ("Ann", "USA", 10.3)]
    assert rows(reports.top_customers(details, k=None, drop_unmatched=True, digits=None))[-1] == ("Bob", "USA", 10.3)
    assert rows(reports.top_customers(details, digits=None))[-1] == (None, None, 7.005)


def test_top_customers_by_id(make):
    df = make("details", DETAILS).withColumn("customer_id", F.when(F.col("order_id") != 6, F.col("order_id")))
    got = rows(reports.top_customers(df, k=None, by_id=True))
    assert got[-1] == (2, "Ann", "UK", 0.2)
    assert (-1, None, None, 7.01) in got
    assert len(got) == 5
    # An id that is missing and one that was filled earlier are one customer.
    both = df.unionByName(df.filter("order_id = 6").withColumn("customer_id", F.lit(-1)))
    assert (-1, None, None, 14.01) in rows(reports.top_customers(both, k=None, by_id=True))


def test_monthly_revenue(details):
    assert rows(reports.monthly_revenue(details)) == [(None, 7.01), ("2024-01", 10.3), ("2024-03", 20.6)]
    assert rows(reports.monthly_revenue(details, descending=True, drop_unmatched=True)) == [
        ("2024-03", 20.6),
        ("2024-01", 10.3),
    ]
    assert rows(reports.monthly_revenue(details, year_and_month=True, drop_unmatched=True, digits=None)) == [
        (2024, 1, 10.3),
        (2024, 3, 20.6),
    ]


def test_monthly_revenue_window_includes_its_first_day(details):
    def months(**options):
        return rows(reports.monthly_revenue(details, **options))

    assert months(as_of="2024-07-29", days=180) == [("2024-01", 0.2), ("2024-03", 20.6)]
    assert months(as_of="2024-07-30") == [("2024-03", 20.6)]
    assert months(as_of="2024-07-30", months=7) == [("2024-01", 10.3), ("2024-03", 20.6)]
    assert months(as_of=dates.newest(details), days=117) == [("2024-03", 20.6)]
    assert months(as_of=dates.newest(details), days=116) == [("2024-03", 10.3)]
    assert months(as_of="2030-01-01") == []


def test_popular_categories(details):
    assert rows(reports.popular_categories(details)) == [("Office", 2), ("Sports", 2), (None, 1)]
    assert rows(reports.popular_categories(details, k=1)) == [("Office", 2)]
    assert rows(reports.popular_categories(details, drop_unmatched=True)) == [("Office", 2), ("Sports", 2)]


def test_order_status(details):
    assert rows(reports.order_status(details)) == [
        ("completed", 5, 62.5),
        ("Completed", 1, 12.5),
        ("cancelled", 1, 12.5),
        ("pending", 1, 12.5),
    ]
    assert rows(reports.order_status(details, percentage=False, by_status=True)) == [
        ("Completed", 1),
        ("cancelled", 1),
        ("completed", 5),
        ("pending", 1),
    ]


def test_order_status_rounding(spark):
    df = spark.range(800).select(F.when(F.col("id") == 0, "pending").otherwise("completed").alias("status"))
    assert rows(reports.order_status(df))[1] == ("pending", 1, 0.13)
    assert rows(reports.order_status(df, rounding=shares.HALF_EVEN))[1] == ("pending", 1, 0.12)


def test_empty_input(make):
    empty = make("details", [])
    for result in (
        reports.top_customers(empty),
        reports.monthly_revenue(empty),
        reports.popular_categories(empty),
        reports.order_status(empty),
    ):
        assert rows(result) == []


def test_summed_rows_give_the_same_reports(details):
    summed = sums.presum(details, "customer_name", "country", "category", "status", "order_date")
    for report in (reports.top_customers, reports.monthly_revenue, reports.popular_categories, reports.order_status):
        assert rows(report(summed)) == rows(report(details))


def test_sql_text_gives_the_same_reports(spark, details):
    assert rows(sql_reports.report(spark, "top_customers", details)) == rows(reports.top_customers(details))
    assert rows(sql_reports.report(spark, "popular_categories", details)) == rows(reports.popular_categories(details, k=5))
    assert rows(sql_reports.report(spark, "order_status", details)) == rows(reports.order_status(details))
    assert rows(sql_reports.report(spark, "monthly_revenue", details)) == rows(
        reports.monthly_revenue(details, descending=True)
    )
    assert rows(sql_reports.report(spark, "monthly_revenue", details, as_of="2024-07-30")) == [("2024-03", 20.6)]
    for months in (6, 7):
        assert rows(sql_reports.report(spark, "monthly_revenue", details, as_of="2024-07-31", months=months)) == rows(
            reports.monthly_revenue(details, descending=True, as_of="2024-07-31", months=months)
        )
    assert rows(sql_reports.report(spark, "top_customers", details, k=None)) == rows(reports.top_customers(details, k=None))
    assert rows(sql_reports.report(spark, "popular_categories", details, k=1)) == [("Office", 2)]
    with pytest.raises(ValueError):
        sql_reports.statement("monthly_revenue", as_of="2024-07-31' OR 'a")


def test_sql_text_reads_only_its_columns(spark, details):
    for name, columns in sql_reports.COLUMNS.items():
        assert rows(sql_reports.report(spark, name, details.select(*columns))) == rows(
            sql_reports.report(spark, name, details)
        )


def test_sql_text_over_a_view(spark, details):
    details.createOrReplaceTempView("order_details")
    got = rows(spark.sql(sql_reports.statement("top_customers")))
    spark.catalog.dropTempView("order_details")
    assert got == rows(reports.top_customers(details))


CUSTOMERS = [(1, "Ann", None, "UK"), (1, "Ann", None, "USA"), (2, "Bob", None, None), (3, "Ann", None, "UK")]
PRODUCTS = [(10, "Pen", "Office", 1.0), (11, "Ball", None, 2.0)]
ORDERS = [
    (i, [1, 2, 3, 999, None][i % 5], [10, 11, 999][i % 3], "2024-01-05", i / 8, ["completed", "pending"][i % 7 == 0])
    for i in range(100)
]


@pytest.mark.parametrize("variant", [FILL, DROP, DROP_ONLY])
@pytest.mark.parametrize("drop_unmatched", [True, False])
def test_star_reports_equal_reports_over_details(make, variant, drop_unmatched):
    inputs = Inputs(make("orders", ORDERS), make("customers", CUSTOMERS), make("products", PRODUCTS), variant)
    options = {"k": None, "drop_unmatched": drop_unmatched}
    details = inputs.order_details(("customer_id", "customer_name", "country", "amount", "status"))
    for by_id in (False, True):
        assert rows(inputs.top_customers(by_id=by_id, **options)) == rows(
            reports.top_customers(details, by_id=by_id, **options)
        )
    one_each = Inputs(make("orders", ORDERS), make("customers", CUSTOMERS[1:]), make("products", PRODUCTS), variant)
    assert rows(one_each.popular_categories(**options)) == rows(
        reports.popular_categories(one_each.order_details(), **options)
    )


def test_plans(details):
    assert "TakeOrderedAndProject" in plan(reports.top_customers(details))
    for result in (
        reports.top_customers(details),
        reports.monthly_revenue(details),
        reports.popular_categories(details),
        reports.order_status(details),
    ):
        text = plan(result)
        assert "partial_" in text
        assert "Python" not in text and "Window" not in text and "Cartesian" not in text


def test_order_status_reads_its_rows_once(spark, details, tmp_path):
    path = str(tmp_path / "details")
    details.write.parquet(path)
    result = reports.order_status(spark.read.parquet(path))
    result.collect()
    assert "ReusedExchange" in plan(result)


def test_report_sets(details):
    got = {
        style: {name: rows(df) for name, df in report_set(details, style, as_of="2024-08-31").items()} for style in STYLES
    }
    counts = [("completed", 5), ("Completed", 1), ("cancelled", 1), ("pending", 1)]
    shares_ = [("completed", 5, 62.5), ("Completed", 1, 12.5), ("cancelled", 1, 12.5), ("pending", 1, 12.5)]
    top = [("Ann", "UK", 10.3), ("Ann", "USA", 10.3), ("Bob", "USA", 10.3), (None, None, 7.01)]
    ranked = [("Office", 2), ("Sports", 2), (None, 1)]
    months = [(None, 7.01), ("2024-01", 10.3), ("2024-03", 20.6)]
    assert got == {
        "dataframe": {"top_customers": top, "monthly_revenue": months, "popular_categories": ranked, "order_status": counts},
        "sql": {
            "top_customers": top,
            "monthly_revenue": months[:0:-1] + months[:1],
            "popular_categories": ranked,
            "order_status": shares_,
        },
        "pandas": {
            "top_customers": top[:3],
            "monthly_revenue": [(2024, 1, 10.3), (2024, 3, 20.6)],
            "popular_categories": ranked[:2],
            "order_status": sorted(shares_),
        },
        "recent": {
            "top_customers": top,
            "monthly_revenue": [("2024-03", 20.6)],
            "popular_categories": ranked,
            "order_status": shares_,
        },
        "complete": {
            "top_customers": top,
            "monthly_revenue": [("2024-03", 20.6)],
            "popular_categories": ranked,
            "order_status": shares_,
        },
    }


def test_report_set_arguments(details):
    with pytest.raises(ValueError, match="as_of"):
        report_set(details, "recent")
    with pytest.raises(ValueError, match="style"):
        report_set(details, "other")


def test_complete_and_limited_sets_differ(make):
    many = make("details", [(i, f"c{i}", "UK", "p", f"k{i}", 1.0, "completed", day("2024-01-01")) for i in range(9)])
    sizes = {
        style: [report_set(many, style, "2024-01-02")[name].count() for name in ("top_customers", "popular_categories")]
        for style in STYLES
    }
    assert sizes == {"dataframe": [5, 9], "sql": [5, 5], "pandas": [5, 9], "recent": [5, 5], "complete": [9, 9]}
