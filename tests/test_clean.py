from __future__ import annotations

import datetime
import math

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillroll.operators import clean, reports

DAY = datetime.date(2024, 3, 17)
ORDERS = [
    (1, 10, 20, "2024-03-17", 5.0, "completed"),
    (2, None, None, None, None, None),
    (3, 10, 20, "2024-13-99", 5.0, "pending"),
    (4, 10, 20, "2024-03-17", 5.0, "bogus"),
    (None, 10, 20, "2024-03-17", 5.0, "completed"),
    (6, 10, 20, "2024-03-17", math.nan, "cancelled"),
    (7, 10, 20, "2024-03-17", 5.0, "Completed"),
]


def test_fill_policy(make):
    got = rows(clean.orders(make("orders", ORDERS), "fill").orderBy("order_id"))
    assert got == [
        (1, 10, 20, DAY, 5.0, "completed"),
        (2, -1, -1, datetime.date(1970, 1, 1), 0.0, "unknown"),
        (3, 10, 20, None, 5.0, "pending"),
        (6, 10, 20, DAY, 0.0, "cancelled"),
    ]


def test_fill_policy_can_leave_keys_null(make):
    kept = clean.orders(make("orders", ORDERS), "fill", fill_keys=False).filter("order_id = 2")
    assert rows(kept.select("customer_id", "product_id")) == [(None, None)]


def test_drop_policy_equals_na_drop(make):
    orders = make("orders", ORDERS)
    got = clean.orders(orders, "drop").orderBy("order_id")
    assert [row.order_id for row in got.collect()] == [1, 3, 4, 7]
    assert sorted(r.order_id for r in orders.na.drop().collect()) == [1, 3, 4, 7]


def test_none_policy_keeps_all_rows(make):
    assert clean.orders(make("orders", ORDERS), "none").count() == len(ORDERS)


def test_unknown_policy(make):
    for cleaner, kind in ((clean.orders, "orders"), (clean.customers, "customers"), (clean.products, "products")):
        with pytest.raises(ValueError, match="policy"):
            cleaner(make(kind, []), "drop rows")


def test_dimensions(make):
    customers = make("customers", [(1, None, None, None), (2, "Ann", "invalid_email", "UK")])
    assert rows(clean.customers(customers).orderBy("customer_id")) == [
        (1, "Unknown Customer", "unknown@example.com", "Unknown"),
        (2, "Ann", "invalid_email", "UK"),
    ]
    products = make("products", [(1, None, None, None), (2, "Pen", "Office", -99.99), (3, "Ink", "Office", math.nan)])
    assert rows(clean.products(products).orderBy("product_id")) == [
        (1, "Unknown Product", "Uncategorized", 0.0),
        (2, "Pen", "Office", -99.99),
        (3, "Ink", "Office", 0.0),
    ]
    assert clean.products(products, "none").columns == ["product_id", "product_name", "category", "price"]


def test_drop_policy_reaches_the_scan(spark, make, tmp_path):
    make("orders", ORDERS).write.parquet(str(tmp_path / "orders"))
    text = plan(clean.orders(spark.read.parquet(str(tmp_path / "orders")), "drop"))
    for name in ("order_id", "customer_id", "product_id", "order_date", "amount", "status"):
        assert f"IsNotNull({name})" in text
    assert "Python" not in text


def test_status_tests_reach_the_scan_of_filled_orders(spark, make, tmp_path):
    make("orders", ORDERS).write.parquet(str(tmp_path / "orders"))
    orders = clean.orders(spark.read.parquet(str(tmp_path / "orders")), "fill")
    assert "Or(IsNull(status),In(status, [cancelled,completed,pending,unknown]))" in plan(orders)
    assert "EqualNullSafe(status,completed)" in plan(reports.completed(orders))


def test_one_row_per_key(spark, make):
    rows = [(1, "a", None, "UK"), (1, "b", "b@x.y", "UK"), (1, "z", None, None), (2, None, None, None), (2, None, None, None), (None, "n", None, None), (None, "m", None, None)]
    got = clean.one_per_key(make("customers", rows), "customer_id")
    assert got.columns == ["customer_id", "name", "email", "country"]
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "b", "b@x.y", "UK"), (2, None, None, None), (None, "n", None, None)]
    latest = clean.one_per_key(make("customers", rows), "customer_id", prefer=[F.col("name")])
    assert {tuple(r)[:2] for r in latest.collect()} == {(1, "z"), (2, None), (None, "n")}
    assert clean.one_per_key(make("customers", []), "customer_id").collect() == []
