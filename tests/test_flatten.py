from __future__ import annotations

import pytest
from helpers import optimized, plan, rows
from pyspark.sql import functions as F

from tillroll.operators import clean, flatten
from tillroll.plans.inputs import DROP, DROP_ONLY, FILL, Inputs

CUSTOMERS = [(1, "Ann", "a@x.org", "UK"), (2, None, "b@x.org", "USA"), (3, "Cem", "c@x.org", None)]
PRODUCTS = [(10, "Pen", "Office", 1.0), (11, None, None, 2.0)]
ORDERS = [
    (1, 1, 10, "2024-01-05", 10.0, "completed"),
    (2, 2, 11, "2024-01-06", 20.0, "completed"),
    (3, 999, 10, "2024-02-07", 30.0, "pending"),
    (4, None, None, "2024-02-08", 40.0, "cancelled"),
    (5, 3, 999, "2024-02-09", 50.0, "bogus"),
]


@pytest.fixture
def inputs(make):
    def build(variant, orders=ORDERS, customers=CUSTOMERS):
        return Inputs(make("orders", orders), make("customers", customers), make("products", PRODUCTS), variant)

    return build


def names(df):
    return rows(df.orderBy("order_id").select("order_id", "customer_name", "country", "product_name", "category"))


def test_fill_variant(inputs):
    assert names(inputs(FILL).order_details()) == [
        (1, "Ann", "UK", "Pen", "Office"),
        (2, "Unknown Customer", "USA", "Unknown Product", "Uncategorized"),
        (3, "Unknown Customer", "Unknown", "Pen", "Office"),
        (4, "Unknown Customer", "Unknown", "Unknown Product", "Uncategorized"),
    ]


def test_drop_variant(inputs):
    assert names(inputs(DROP).order_details()) == [
        (1, "Ann", "UK", "Pen", "Office"),
        (2, "Unknown Customer", "USA", "Unknown Product", "Uncategorized"),
        (3, "Unknown Customer", "Unknown", "Pen", "Office"),
        (5, "Cem", "Unknown", "Unknown Product", "Uncategorized"),
    ]


def test_drop_only_variant(inputs):
    assert names(inputs(DROP_ONLY).order_details()) == [
        (1, "Ann", "UK", "Pen", "Office"),
        (2, None, "USA", None, None),
        (3, None, None, "Pen", "Office"),
        (5, "Cem", None, None, None),
    ]


def test_columns_and_order_of_the_result(inputs):
    assert inputs(FILL).order_details().columns == list(flatten.COLUMNS)
    assert inputs(FILL).order_details(("customer_id", "status")).columns == ["customer_id", "status"]


def test_key_sentinels_do_not_change_the_result(make):
    customers = clean.customers(make("customers", CUSTOMERS))
    products = clean.products(make("products", PRODUCTS))
    results = [
        names(flatten.order_details(clean.orders(make("orders", ORDERS), fill_keys=keys), customers, products))
        for keys in (True, False)
    ]
    assert results[0] == results[1]


@pytest.mark.parametrize("hot_share", [None, 0.01])
def test_repeated_dimension_key_repeats_the_order(inputs, hot_share):
    twice = inputs(FILL, customers=[*CUSTOMERS, (1, "Ann again", None, "UK")])
    got = twice.order_details(hot_share=hot_share).filter("order_id = 1")
    assert sorted(row.customer_name for row in got.collect()) == ["Ann", "Ann again"]


def test_unneeded_dimension_is_joined_only_for_its_fan_out(inputs):
    columns = ("order_id", "category")
    assert optimized(inputs(FILL).order_details(columns)).count("Join") == 2
    assert optimized(inputs(FILL).order_details(columns, unique_keys=True)).count("Join") == 1
    assert optimized(inputs(FILL).order_details(("order_id",), unique_keys=True)).count("Join") == 0


def skewed(spark, n=60_000):
    """A third of the rows has no customer, a third has customer 1."""
    third = F.col("id") % 3
    return spark.range(n).select(
        F.col("id").cast("int").alias("order_id"),
        F.when(third == 1, 1).when(third == 2, F.col("id").cast("int")).alias("customer_id"),
        F.lit(10).alias("product_id"),
        F.repeat(F.lit("x"), 200).alias("status"),
    )


def many_customers(spark, n=60_000):
    return spark.range(n).select(
        F.col("id").cast("int").alias("customer_id"), F.concat(F.lit("c"), "id").alias("name"), F.lit("UK").alias("country")
    )


def test_adaptive_execution_splits_hot_and_null_keys(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="32KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    df = flatten.with_customers(skewed(spark).repartition(8), many_customers(spark))
    assert len(df.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan(df)


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_salted_join_equals_the_plain_join(spark, conf, broadcast):
    conf(autoBroadcastJoinThreshold=broadcast)
    orders, customers = skewed(spark, 3000), many_customers(spark, 2000)
    hot = flatten.hot_keys(orders, ["customer_id"], 0.05)["customer_id"]
    assert sorted(rows(hot), key=str) == [(1, 7), (None, 7)]
    salted = flatten.with_customers(orders, customers, hot=hot)
    plain = flatten.with_customers(orders, customers)
    assert salted.columns == plain.columns
    assert sorted(rows(salted), key=str) == sorted(rows(plain), key=str)


def test_salted_join_spreads_a_hot_key(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", shuffle__partitions="32", adaptive__enabled="false")
    orders = skewed(spark, 6000)
    hot = flatten.hot_keys(orders, ["customer_id"], 0.02)["customer_id"]
    salted = flatten.with_customers(orders, many_customers(spark, 100), hot=hot)
    sizes = salted.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    assert sizes.sum() == 6000
    assert sizes.max() < 6000 / 6  # one third would be 2,000


def test_sketches_are_merged_in_steps(spark):
    """What the last task merges does not grow with the number of partitions."""
    many = skewed(spark, 3000).repartition(200)
    assert sorted(rows(flatten.hot_keys(many, ["customer_id"], 0.05)["customer_id"]), key=str) == [(1, 7), (None, 7)]


def test_hot_share_must_be_a_share(spark):
    with pytest.raises(ValueError):
        flatten.hot_keys(skewed(spark, 10), ["customer_id"], 2)


def test_without_hot_keys_the_join_is_plain(spark):
    orders = skewed(spark, 3000).filter("customer_id > 1")
    assert flatten.hot_keys(orders, ["customer_id"], 0.1) == {}
    assert list(flatten.hot_keys(skewed(spark, 3000), ["customer_id", "product_id"], 0.1)) == ["customer_id", "product_id"]
