from __future__ import annotations

import math

from helpers import rows

from tillroll.operators import quality
from tillroll.sources import defects


def test_audit(make):
    customers = make(
        "customers",
        [(1, "Ann", "a@x.org", "UK"), (1, None, "no at.org", None), (1, "A", None, "UK"), (None, "B", "b@x", "UK")],
    )
    products = make("products", [(10, "Pen", "Office", 1.0), (11, None, None, -1.0), (11, "Ink", "Office", math.nan)])
    orders = make(
        "orders",
        [
            (1, 1, 10, "2024-01-01", 1.0, "completed"),
            (2, 9, 9, "2024-13-99", None, "bogus"),
            (3, 9, 10, None, 1.0, None),
            (None, None, None, "2024-01-01", math.nan, "pending"),
        ],
    )
    found = {(table, rule): n for table, rule, n in rows(quality.audit(orders, customers, products))}
    assert len(found) == 22
    assert {key: n for key, n in found.items() if n} == {
        ("customers", "customer_id null"): 1,
        ("customers", "name null"): 1,
        ("customers", "email null"): 1,
        ("customers", "country null"): 1,
        ("customers", "email invalid"): 2,
        ("customers", "customer_id duplicate"): 2,
        ("products", "name null"): 1,
        ("products", "category null"): 1,
        ("products", "price null"): 1,
        ("products", "price negative"): 1,
        ("products", "product_id duplicate"): 1,
        ("orders", "order_id null"): 1,
        ("orders", "customer_id null"): 1,
        ("orders", "product_id null"): 1,
        ("orders", "order_date null"): 1,
        ("orders", "amount null"): 2,
        ("orders", "status null"): 1,
        ("orders", "status unlisted"): 1,
        ("orders", "order_date malformed"): 1,
        ("orders", "customer orphan"): 2,
        ("orders", "product orphan"): 1,
    }


def test_audit_of_empty_tables(make):
    found = quality.audit(make("orders", []), make("customers", []), make("products", []))
    assert {row.violations for row in found.collect()} == {0}


def test_row_counts(make, spark):
    orders = make("orders", [(1, 1, 1, None, None, None)] * 3)
    assert rows(quality.row_counts({"orders": orders, "none": orders.limit(0)})) == [("orders", 3), ("none", 0)]
    assert rows(quality.table_row_counts(spark, "default", ("missing",))) == [("missing", None)]


def test_quarantine_adds_up_to_the_audit(spark):
    tables = [f(spark, "/root/testdata/sf0.001") for f in (defects.orders, defects.customers, defects.products)]
    tables[1] = tables[1].union(tables[1].filter("customer_id < 9")).union(tables[1].filter("customer_id < 4"))
    found = quality.quarantine(*tables)
    sums = {(r.table_name, r.rule): r.n for r in found.groupBy("table_name", "rule").agg({"violations": "sum"}).toDF("table_name", "rule", "n").collect()}
    audit = {(r.table_name, r.rule): r.violations for r in quality.audit(*tables).collect() if r.violations}
    assert sums == audit and ("customers", "customer_id duplicate") in sums
    record = found.filter("table_name = 'orders' AND rule = 'status unlisted'").first().record
    assert '"status":"bogus"' in record
