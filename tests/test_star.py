"""The registered queries against their SQL oracles, and properties of their plans."""

from __future__ import annotations

import oracle_check
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracles import ORACLES
from tillroll import session
from tillroll.functions import dates
from tillroll.operators import flatten, reports
from tillroll.plans import star_reports
from tillroll.plans.inputs import FILL, from_defects, star_order_details
from tillroll.sources import defects, star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


def test_every_query_has_an_oracle():
    """The queries of the optional subpackage are tested beside it."""
    assert entry.queries().keys() - entry._llm_queries().keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_oracle(spark, con, name):
    assert oracle_check.compare(spark, con, name, SF) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["customer_name", "country", "total_spend"]


def test_status_filter_reaches_the_scan(spark, conf):
    text = plan(entry.queries()["top_customers"](spark, SF))
    assert "EqualNullSafe(o_orderstatus,F)" in text
    assert "Python" not in text
    assert "email" not in text and "c_acctbal" not in text


def scanned(df) -> list[int]:
    """Rows that each Parquet scan returned, after running ``df``."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        inner = {"AdaptiveSparkPlan": "executedPlan", "ReusedExchange": "child"}.get(name)
        if name.endswith("QueryStage"):
            inner = "plan"
        children = [getattr(node, inner)()] if inner else [node.children().apply(i) for i in range(node.children().size())]
        todo.extend(children)
    return sorted(found)


def test_window_skips_row_groups(spark, tmp_path):
    """A DATE column in many row groups: the scan returns little more than the window."""
    path = str(tmp_path / "orders")
    days = spark.range(100_000).selectExpr(
        "id AS order_id", "date_add(DATE '2020-01-01', CAST(id DIV 50 AS INT)) AS order_date", "1.5D AS amount", "'completed' AS status"
    )
    days.coalesce(1).sortWithinPartitions("order_date").write.option("parquet.block.size", 20_000).parquet(path)
    table = spark.read.parquet(path)
    recent = reports.monthly_revenue(table, since=dates.trailing_start(table, days=100))
    rows_read = [n for n in scanned(recent) if n < 100_000]
    assert rows_read and max(rows_read) < 20_000
    assert rows(recent) == rows(reports.monthly_revenue(table, as_of=dates.newest(table), days=100))


def test_window_joins_the_filtered_headers(spark):
    text = plan(entry.queries()["monthly_revenue_recent"](spark, SF))
    assert "Subquery" in text and text.index("HashAggregate(keys=[o_orderkey") < text.index("Join")


def test_sql_reports_sum_before_the_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    for name, key in (("top_customers_sql", "customer_id"), ("popular_categories_all_sql", "product_id")):
        text = plan(entry.queries()[name](spark, SF))
        join = text.index(f"SortMergeJoin [{key}")
        assert f"HashAggregate(keys=[{key}" in text[join:]


def test_orphans_stay_orphans(spark):
    """Also beside a dimension that holds every key a table could: planted keys are negative and never -1."""
    orders = defects.orders(spark, SF)
    found = orders.filter("customer_id < 0 OR product_id < 0").select("customer_id", "product_id")
    keys = [k for row in found.collect() for k in row if k is not None and k < 0]
    assert keys and max(keys) <= -1000 and len(set(keys)) > len(keys) / 10


def test_schema_is_read_again_when_a_table_changes(spark, tmp_path):
    path = str(tmp_path / "part.parquet")
    spark.range(3).write.parquet(path)
    assert star.table(spark, str(tmp_path), "part").columns == ["id"]
    spark.range(3).selectExpr("id", "id AS more").write.mode("overwrite").parquet(path)
    assert star.table(spark, str(tmp_path), "part").columns == ["id", "more"]


def test_queries_leave_nothing_after_cleanup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda _: str(tmp_path))
    before = {row.namespace for row in spark.sql("SHOW DATABASES").collect()}
    entry.queries()["publish_append"](spark, SF).count()
    entry.queries()["csv_one_file"](spark, SF).count()
    session.cleanup(spark)
    assert {row.namespace for row in spark.sql("SHOW DATABASES").collect()} <= before
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_headers_are_joined_only_when_needed(spark):
    assert "Join" not in plan(star.orders(spark, SF, ("order_id", "product_id", "amount")))
    assert "Join" in plan(star.orders(spark, SF, ("order_id", "status")))


def test_lines_are_summed_before_the_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(reports.monthly_revenue(star.order_sums(spark, SF)))
    assert text.index("SortMergeJoin") < text.index("partial_sum(cast(nanvl(l_extendedprice")
    assert text.count("hashpartitioning(l_orderkey") == 1


def test_orders_meet_customers_summed(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(from_defects(spark, SF, FILL).top_customers())
    join = text.index("SortMergeJoin [customer_id")
    assert text.index("HashAggregate(keys=[customer_id", join) < text.index("SortMergeJoin [l_orderkey", join)


def test_details_of_the_star_equal_the_general_plan(spark):
    one, other = star_order_details(spark, SF), flatten.order_details(star.orders(spark, SF), star.customers(spark, SF), star.products(spark, SF))
    assert one.columns == other.columns
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_properties_of_the_reports(spark):
    orders = star.orders(spark, SF)
    status = rows(reports.order_status(orders))
    assert sum(n for _, n, _ in status) == orders.count()
    assert abs(sum(p for *_, p in status) - 100) <= 0.02
    spent = star_reports.top_customers(orders, star.customers(spark, SF), k=None).agg(F.sum(F.col("total_spend").cast("decimal(18,2)")))
    earned = reports.monthly_revenue(orders).agg(F.sum(F.col("monthly_revenue").cast("decimal(18,2)")))
    assert spent.first()[0] == earned.first()[0]
