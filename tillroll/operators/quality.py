"""Data-quality audit and row-count reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import dates
from tillroll.operators import clean

# Fixed value: what counts as an email address.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def audit(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    product_ids: DataFrame | None = None,
) -> DataFrame:
    """Violations per rule: table_name, rule, violations.

    Orders are counted per customer id and per product id before they meet the
    dimensions, so the joins see one row per id however often it occurs, and the
    first pass answers the row rules as well. ``product_ids`` may give the orders'
    product ids from a cheaper plan than ``orders``.
    """
    product_ids = orders if product_ids is None else product_ids
    customer_keys = _per_key(customers, "customer_id", customer_rules())
    product_keys = _per_key(products, "product_id", product_rules(products))
    by_customer = _per_key(orders, "customer_id", order_rules(orders))
    by_product = _per_key(product_ids, "product_id", {})
    return _totals(by_customer, customer_keys, "customer_id", "customers", "customer orphan").unionByName(
        _totals(by_product, product_keys, "product_id", "products", "product orphan")
    )


def customer_rules() -> dict[str, Column]:
    """What breaks each rule of a customer row."""
    return {
        "customer_id null": F.col("customer_id").isNull(),
        "name null": F.col("name").isNull(),
        "email null": F.col("email").isNull(),
        "country null": F.col("country").isNull(),
        "email invalid": ~F.col("email").rlike(EMAIL_PATTERN),
    }


def product_rules(products: DataFrame) -> dict[str, Column]:
    return {
        "product_id null": F.col("product_id").isNull(),
        "name null": F.col("name").isNull(),
        "category null": F.col("category").isNull(),
        "price null": ~clean.is_present(products, "price"),
        "price negative": F.col("price") < 0,
    }


def order_rules(orders: DataFrame) -> dict[str, Column]:
    return {
        "order_id null": F.col("order_id").isNull(),
        "customer_id null": F.col("customer_id").isNull(),
        "product_id null": F.col("product_id").isNull(),
        "order_date null": F.col("order_date").isNull(),
        "amount null": ~clean.is_present(orders, "amount"),
        "status null": F.col("status").isNull(),
        "status unlisted": ~F.col("status").isin(*schemas.STATUSES),
        "order_date malformed": F.col("order_date").isNotNull() & dates.parse(F.col("order_date")).isNull(),
    }


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``broken``: the names of the rules that each row breaks, in one pass."""
    return df.withColumn("broken", F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])))


def quarantine(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The rows behind ``audit``: table_name, rule, record_key, violations and record (the row as JSON).

    A row that breaks several rules comes once for each. A repeated key of a dimension comes once, with its
    surplus rows as violations and without a record. Violations add up to those of ``audit``.
    Dimensions meet the orders as distinct keys; a hot key's part of that join can be split.
    """
    known = orders
    for dimension, key in ((customers, "customer_id"), (products, "product_id")):
        ids = dimension.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(f"_known_{key}", F.lit(True))
        known = known.join(ids, key, "left")
    orphans = {
        f"{name} orphan": F.col(f"{name}_id").isNotNull() & F.col(f"_known_{name}_id").isNull() for name in ("customer", "product")
    }
    parts = [
        _records(known, "orders", "order_id", order_rules(orders) | orphans, orders.columns),
        _records(customers, "customers", "customer_id", customer_rules(), customers.columns),
        _records(products, "products", "product_id", product_rules(products), products.columns),
        _surplus(customers, "customers", "customer_id"),
        _surplus(products, "products", "product_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _records(df: DataFrame, table: str, key: str, rules: dict[str, Column], columns: list[str]) -> DataFrame:
    found = broken_rules(df, rules).filter(F.size("broken") > 0)
    return found.select(
        F.lit(table).alias("table_name"),
        F.explode("broken").alias("rule"),
        F.col(key).cast("string").alias("record_key"),
        F.lit(1).cast("bigint").alias("violations"),
        F.to_json(F.struct(*columns)).alias("record"),
    )


def _surplus(df: DataFrame, table: str, key: str) -> DataFrame:
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(f"{key} duplicate").alias("rule"),
        F.col(key).cast("string").alias("record_key"),
        (F.col("n") - 1).alias("violations"),
        F.lit(None).cast("string").alias("record"),
    )


def _per_key(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Rows and violations per key."""
    return df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()]
    )


def _totals(facts: DataFrame, keys: DataFrame, key: str, table: str, orphan_rule: str) -> DataFrame:
    """One output row per rule of a dimension and of the orders counted by its key.

    Both are grouped by the key already, so a full join meets them where they are: each is
    computed once, for its own rules, for duplicates and for orphans.
    """

    def named(df: DataFrame, owner: str) -> DataFrame:
        return df.select(key, *[F.col(f"`{c}`").alias(f"{owner}|{c}") for c in df.columns if c != key])

    both = named(facts, "orders").join(named(keys, table), key, "full_outer")
    known = F.col(key).isNotNull()
    surplus, orphans = F.col(f"`{table}|_rows`") - 1, F.col("`orders|_rows`")
    both = both.withColumns(
        {
            f"{table}|{key} duplicate": F.when(known, surplus),
            f"orders|{orphan_rule}": F.when(known & F.col(f"`{table}|_rows`").isNull(), orphans),
        }
    )
    rules = [c for c in both.columns if c != key and not c.endswith("|_rows")]
    totals = both.agg(*[F.coalesce(F.sum(F.col(f"`{rule}`")), F.lit(0)).alias(rule) for rule in rules])
    parts = F.split("rule", r"\|")
    return totals.unpivot([], [F.col(f"`{rule}`") for rule in rules], "rule", "violations").select(
        parts[0].alias("table_name"), parts[1].alias("rule"), "violations"
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """table_name and row_count of several DataFrames, as one DataFrame."""
    report = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        report = one if report is None else report.unionByName(one)
    return report


def table_row_counts(
    spark: SparkSession, database: str, tables: tuple[str, ...] = schemas.OUTPUT_TABLES
) -> DataFrame:
    """Rows of each output table in a database; null for a table that is missing."""
    frames = {name: spark.table(f"{database}.{name}") for name in tables if spark.catalog.tableExists(f"{database}.{name}")}
    report = spark.createDataFrame(
        [(name,) for name in tables if name not in frames], "table_name STRING"
    ).withColumn("row_count", F.lit(None).cast("bigint"))
    return report.unionByName(row_counts(frames)) if frames else report
