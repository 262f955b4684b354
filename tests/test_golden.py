"""Results that were published beside the inputs, read as data from a folder given with ``--golden``."""

from __future__ import annotations

import pathlib

import pytest
from helpers import rows

from tillroll import schemas
from tillroll.operators import reports
from tillroll.plans.inputs import FILL, Inputs
from tillroll.plans.report_sets import report_set
from tillroll.sources import files


@pytest.fixture
def golden(request):
    folder = request.config.getoption("--golden")
    if not folder or not pathlib.Path(folder, "order_details.csv").exists():
        pytest.skip("give the folder of published results with --golden")
    return folder


@pytest.fixture
def details(spark, golden):
    customers, products, orders = files.read_inputs(spark, golden)
    return Inputs(orders, customers, products, FILL).order_details()


def published(spark, golden, name, schema):
    return rows(files.read_csv(spark, f"{golden}/{name}.csv", schema))


def test_order_details(spark, golden, details):
    want = published(spark, golden, "order_details", schemas.order_details())
    assert len(want) == 200 and sorted(rows(details)) == sorted(want)


def test_reports(spark, golden, details):
    found = report_set(details, "sql")
    assert rows(found["top_customers"]) == published(spark, golden, "top_customers", schemas.TOP_CUSTOMERS)
    assert rows(found["popular_categories"]) == published(spark, golden, "popular_categories", schemas.POPULAR_CATEGORIES)
    assert sorted(rows(found["order_status"])) == sorted(published(spark, golden, "order_status", schemas.ORDER_STATUS))


def test_window_by_wall_clock_was_empty(spark, golden, details):
    """The published revenue covers a window long after the orders, so it has no rows."""
    want = published(spark, golden, "monthly_revenue", schemas.MONTHLY_REVENUE)
    assert rows(reports.monthly_revenue(details, as_of="2025-12-31")) == want == []


def test_six_months(details):
    months = rows(reports.monthly_revenue(details))
    assert [month for month, _ in months] == [f"2024-0{i}" for i in range(1, 7)]
    completed = details.filter("status = 'completed'").selectExpr("sum(CAST(amount AS DECIMAL(18,2)))").first()[0]
    assert round(sum(value for _, value in months), 2) == float(completed)
