"""Loads that run again, fail or are withdrawn, and what is read of them."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tillroll import session
from tillroll.functions import dates
from tillroll.operators import reports
from tillroll.plans.loads import Loads
from tillroll.sinks import catalog


def day(text):
    return datetime.date.fromisoformat(text)


FIRST = [
    (1, "Ada", "UK", "Pen", "Office", 10.5, "completed", day("2024-01-03")),
    (2, "Bob", "US", "Pen", "Office", 0.1, "completed", day("2024-02-10")),
    (3, "Ada", "UK", "Mug", "Home", 5.0, "pending", day("2024-02-11")),
]
SECOND = [
    (4, "Ada", "UK", "Mug", "Home", 0.2, "completed", day("2024-03-05")),
    (5, None, None, "Cap", "Home", 7.0, "completed", None),
    (6, "Cyd", "FR", "Cap", "Home", 1.0, "cancelled", day("2023-11-30")),
]


@pytest.fixture
def loads(spark):
    return Loads(spark, *session.new_database(spark))


def details(loads):
    return sorted(rows(loads.order_details().withColumn("amount", F.col("amount").cast("double"))), key=repr)


def test_a_load_that_runs_twice_is_there_once(loads, make):
    loads.load(make("details", FIRST), "2024-02")
    loads.load(make("details", SECOND), "2024-03")
    loads.load(make("details", FIRST), "2024-02")
    assert details(loads) == sorted(FIRST + SECOND, key=repr)


def test_a_load_replaces_its_earlier_self(loads, make):
    loads.load(make("details", FIRST), "a")
    loads.load(make("details", SECOND[:1]), "a")
    assert details(loads) == SECOND[:1]
    loads.load(make("details", []), "a")
    assert details(loads) == [] and rows(loads.report("order_status")) == []


@pytest.mark.parametrize(
    "name, options",
    [
        ("top_customers", {"k": None}),
        ("monthly_revenue", {"year_and_month": True}),
        ("popular_categories", {}),
        ("order_status", {}),
    ],
)
def test_reports_over_loads_equal_one_of_all_rows(loads, make, name, options):
    loads.load(make("details", FIRST), "a")
    loads.load(make("details", SECOND), "b")
    loads.load(make("details", SECOND), "b")
    want = getattr(reports, name)(make("details", FIRST + SECOND), **options)
    got = loads.report(name, **options)
    assert rows(got) == rows(want)
    assert "order_details_loads" not in plan(got)


@pytest.mark.parametrize("broken", ["order_details", "status_sums", "load_facts"])
def test_a_failed_load_leaves_everything_on_the_old_one(loads, make, monkeypatch, broken):
    loads.load(make("details", FIRST), "a")
    before = details(loads), {n: rows(loads.report(n)) for n in ("top_customers", "order_status", "popular_categories")}
    write = catalog.write_table

    def fails(df, table, mode="overwrite"):
        if table.endswith(f"{broken}_loads"):
            raise OSError("no space")
        write(df, table, mode)

    monkeypatch.setattr(catalog, "write_table", fails)
    for load_id in ("a", "b"):
        with pytest.raises(OSError):
            loads.load(make("details", SECOND), load_id)
    assert before == (details(loads), {n: rows(loads.report(n)) for n in before[1]})
    monkeypatch.setattr(catalog, "write_table", write)
    assert loads.remove_unpublished() if broken != "order_details" else True
    assert before[0] == details(loads)


def test_a_load_can_be_withdrawn(loads, make):
    loads.load(make("details", FIRST), "a")
    loads.load(make("details", SECOND), "b")
    loads.withdraw("a")
    assert details(loads) == sorted(SECOND, key=repr) and list(loads.published()) == ["b"]
    removed = loads.remove_unpublished()
    assert len(removed) == 6 and details(loads) == sorted(SECOND, key=repr)


def test_only_months_of_the_window_are_read(loads, make):
    loads.load(make("details", FIRST), "a")
    loads.load(make("details", SECOND), "b")
    df = loads.order_details(loads.window_start(days=30))
    assert sorted(r[0] for r in rows(df)) == [2, 3, 4]
    files = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [files.apply(i) for i in range(files.size())]
    read = [s.finalPhysicalPlan() if "AdaptiveSparkPlan" in s.nodeName() else s for s in scans]
    numbers = []
    for node in read:
        leaves = node.collectLeaves()
        for i in range(leaves.size()):
            metric = leaves.apply(i).metrics().get("numFiles")
            if metric.isDefined():
                numbers.append(metric.get().value())
    # Of six files the months 2024-02 and 2024-03.
    assert sum(numbers) == 2, numbers
    assert rows(loads.order_details(dates.window_start("2023-12-01", 5))) != []


def test_odd_ids_are_refused(loads, make):
    with pytest.raises(ValueError):
        loads.load(make("details", FIRST), "a'; DROP")


def test_nothing_loaded_yet(loads):
    assert details(loads) == [] and rows(loads.report("top_customers")) == []
