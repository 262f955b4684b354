from __future__ import annotations

import datetime
import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tillroll.functions import dates, money, shares

CENTS = st.integers(min_value=-10**9, max_value=10**9)


def total(df, digits=2):
    return df.agg(*money.parts()).select(money.value(digits)).first()[0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(CENTS, min_size=1, max_size=50))
def test_money_sum_is_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "amount DOUBLE").repartition(3)
    assert total(df) == float(Decimal(sum(cents)) / 100)


def test_money_sum_does_not_depend_on_row_order(spark):
    values = [0.1] * 10_000 + [1e9 + 0.01] * 10
    shuffled = random.Random(1).sample(values, len(values))
    one, other = (spark.createDataFrame([(v,) for v in vs], "amount DOUBLE") for vs in (values, shuffled))
    assert total(one.repartition(4)) == total(other.repartition(7)) == 10_000_001_000.1


def test_money_rounds_the_sum_not_the_rows(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(1.005,)], "amount DOUBLE")
    assert total(df) == 5.01  # 5.005 half-up; rounding rows first would give 1.01
    assert total(df, None) == 5.005


def test_money_merges_parts_to_the_same_sum(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") / 100).alias("amount"))
    merged = df.groupBy("g").agg(*money.parts()).agg(*money.merged()).select(money.value())
    assert merged.first()[0] == total(df) == 4995.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(0, 18)), min_size=1, max_size=40))
def test_money_keeps_up_to_18_decimals(spark, amounts):
    exact = [Decimal(value).scaleb(-scale) for value, scale in amounts]
    df = spark.createDataFrame([(float(x),) for x in exact], "amount DOUBLE").repartition(2)
    assert total(df, None) == float(sum(exact))


def test_money_of_amounts_below_a_millionth(spark):
    df = spark.createDataFrame([(0.0000004,)] * 1000 + [(-1e-18,)], "amount DOUBLE")
    assert total(df, None) == float(Decimal('0.0004') - Decimal('1e-18')) and total(df, 4) == 0.0004
    assert total(spark.createDataFrame([(-0.25,), (-1e-9,)], "amount DOUBLE"), None) == -0.250000001


def test_money_skips_missing_and_rejects_infinite_amounts(spark):
    df = spark.createDataFrame([(1.5,), (None,), (float("nan"),)], "amount DOUBLE")
    assert total(df) == 1.5
    with pytest.raises(ArithmeticException):
        total(spark.createDataFrame([(float("inf"),)], "amount DOUBLE"))


def test_money_sql_text_gives_the_same(spark):
    df = spark.createDataFrame([(1.25,), (-0.50,)], "amount DOUBLE")
    assert spark.sql(f"SELECT {money.total_sql()} AS total FROM {{df}}", df=df).first().total == 0.75


@pytest.mark.parametrize("whole", [1, 3, 7, 800, 1600, 59_193, 60_000])
def test_percent_is_exact_for_every_count(spark, whole):
    df = spark.range(whole + 1).select(F.col("id").alias("n"), F.lit(whole).cast("bigint").alias("total"))
    for rounding, mode in ((shares.HALF_UP, ROUND_HALF_UP), (shares.HALF_EVEN, ROUND_HALF_EVEN)):
        got = df.select("n", F.expr(shares.percent_sql("n", "total", rounding)).alias("p")).toPandas()
        wrong = [
            (n, p)
            for n, p in zip(got.n, got.p)
            if p != float((Decimal(int(n)) * 100 / whole).quantize(Decimal("0.01"), rounding=mode))
        ]
        assert not wrong


def test_percent_half_way(spark):
    one = spark.sql(
        f"SELECT {shares.percent_sql('1L', '800L')}, {shares.percent_sql('1L', '800L', shares.HALF_EVEN)}"
    )
    assert rows(one) == [(0.13, 0.12)]
    with pytest.raises(ValueError):
        shares.percent_sql("n", "t", "down")


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-03-17",), ("2024-13-99",), ("2024-03-17 10:11:12",), (None,)], "text STRING"
    ).select(dates.parse(F.col("text")).alias("d"))
    march = datetime.date(2024, 3, 17)
    assert rows(df) == [(march,), (None,), (march,), (None,)]
    months = df.select(dates.month_text(dates.month_start("d")))
    assert rows(months) == [("2024-03",), (None,), ("2024-03",), (None,)]
    assert df.select(dates.newest(df, "d")).first()[0] == march


def test_window_start(spark):
    start = spark.range(1).select(
        dates.window_start("2024-06-29"),
        dates.window_start(datetime.date(2024, 6, 29), days=1),
        dates.window_start("2024-08-31", months=6),
    )
    assert rows(start) == [
        (datetime.date(2024, 1, 1), datetime.date(2024, 6, 28), datetime.date(2024, 2, 29)),
    ]
