"""Deterministic defects over the star tables, for exercising the cleaning rules.

The star tables are clean, so cleaning them changes nothing. These projections
plant each kind of defect by key arithmetic; every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import star

# Keys of the tables are not negative, and -1 stands for a missing key after cleaning.
_ORPHAN = -1000


def _every(key: Column | str, n: int) -> Column:
    return (F.col(key) if isinstance(key, str) else key) % n == 0


def _planted(column: str, *rules: tuple[Column, object]) -> Column:
    """The column, replaced by the value of the first rule that holds."""
    (first, value), *rest = rules
    planted = F.when(first, value if isinstance(value, Column) else F.lit(value))
    for condition, other in rest:
        planted = planted.when(condition, other if isinstance(other, Column) else F.lit(other))
    return planted.otherwise(F.col(column)).alias(column)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = "customer_id"
    return star.customers(spark, folder).select(
        key,
        _planted("name", (_every(key, 61), None)),
        _planted("email", (_every(key, 59), None), (_every(key, 53), "invalid_email")),
        _planted("country", (_every(key, 47), None)),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = "product_id"
    return star.products(spark, folder).select(
        key,
        _planted("name", (_every(key, 61), None)),
        _planted("category", (_every(key, 59), None)),
        _planted("price", (_every(key, 53), None), (_every(key, 47), -99.99)),
    )


def orders(spark: SparkSession, folder: str, columns: tuple[str, ...] = star.ORDER_COLUMNS) -> DataFrame:
    line = F.col("order_id") + F.col("line_number")
    orphan = _ORPHAN - F.col("order_id")  # another key for each order, so that none of them is a hot key
    planted = {
        "order_id": F.col("order_id"),
        "customer_id": _planted("customer_id", (_every(line, 97), None), (_every("order_id", 89), orphan)),
        "product_id": _planted("product_id", (_every(line, 101), None), (_every("product_id", 103), orphan)),
        "order_date": _planted("order_date", (_every("order_id", 71), None), (_every("order_id", 67), "2024-13-99")),
        "amount": _planted("amount", (_every("product_id", 83), None)),
        "status": _planted("status", (_every("order_id", 79), None), (_every("order_id", 73), "bogus")),
    }
    needed = {"order_id", "line_number", "product_id", *columns}
    clean = star.orders(spark, folder, tuple(name for name in ("line_number", *star.ORDER_COLUMNS) if name in needed))
    if "order_date" in needed:
        clean = clean.withColumn("order_date", F.col("order_date").cast("string"))
    return clean.select(*[planted[name] for name in columns])
