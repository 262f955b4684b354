"""Declared schemas, table types and the fixed values of the cleaning rules."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def customers(key: T.DataType = T.IntegerType()) -> T.StructType:
    return _struct(
        ("customer_id", key),
        ("name", T.StringType()),
        ("email", T.StringType()),
        ("country", T.StringType()),
    )


def products(key: T.DataType = T.IntegerType()) -> T.StructType:
    return _struct(
        ("product_id", key),
        ("name", T.StringType()),
        ("category", T.StringType()),
        ("price", T.DoubleType()),
    )


def orders(key: T.DataType = T.IntegerType()) -> T.StructType:
    """The date stays text here; cleaning turns it into a date."""
    return _struct(
        ("order_id", key),
        ("customer_id", key),
        ("product_id", key),
        ("order_date", T.StringType()),
        ("amount", T.DoubleType()),
        ("status", T.StringType()),
    )


def order_details(key: T.DataType = T.IntegerType()) -> T.StructType:
    return _struct(
        ("order_id", key),
        ("customer_name", T.StringType()),
        ("country", T.StringType()),
        ("product_name", T.StringType()),
        ("category", T.StringType()),
        ("amount", T.DoubleType()),
        ("status", T.StringType()),
        ("order_date", T.DateType()),
    )


TOP_CUSTOMERS = _struct(
    ("customer_name", T.StringType()),
    ("country", T.StringType()),
    ("total_spend", T.DoubleType()),
)
MONTHLY_REVENUE = _struct(("month", T.StringType()), ("monthly_revenue", T.DoubleType()))
MONTHLY_REVENUE_YM = _struct(
    ("year", T.LongType()),
    ("month", T.LongType()),
    ("monthly_revenue", T.DoubleType()),
)
POPULAR_CATEGORIES = _struct(("category", T.StringType()), ("order_count", T.LongType()))
ORDER_STATUS = _struct(
    ("status", T.StringType()),
    ("order_count", T.LongType()),
    ("percentage", T.DoubleType()),
)

# The five output tables, in the order they are filled.
OUTPUT_TABLES = ("order_details", "top_customers", "monthly_revenue", "popular_categories", "order_status")

# The declared types of the output tables.
TABLE_TYPES = {
    "order_details": {
        "order_id": "INT",
        "customer_name": "VARCHAR(255)",
        "country": "VARCHAR(100)",
        "product_name": "VARCHAR(255)",
        "category": "VARCHAR(100)",
        "amount": "DECIMAL(10,2)",
        "status": "VARCHAR(50)",
        "order_date": "DATE",
    },
    "top_customers": {
        "customer_name": "VARCHAR(255)",
        "country": "VARCHAR(100)",
        "total_spend": "DECIMAL(10,2)",
    },
    "monthly_revenue": {"year": "INT", "month": "INT", "monthly_revenue": "DECIMAL(10,2)"},
    "popular_categories": {"category": "VARCHAR(100)", "order_count": "INT"},
    "order_status": {"status": "VARCHAR(50)", "order_count": "INT", "percentage": "DECIMAL(5,2)"},
}

# Types for large inputs. A sum of money gets more digits than a single amount.
_WIDER = {"INT": "BIGINT", "DECIMAL(10,2)": "DECIMAL(28,2)"}


def table_types(table: str, wide: bool = True) -> dict[str, str]:
    """Column types of an output table; ``wide`` widens ids, counts and money."""
    types = dict(TABLE_TYPES[table])
    if wide:
        types = {name: _WIDER.get(kind, kind) for name, kind in types.items()}
        if "amount" in types:
            types["amount"] = "DECIMAL(18,2)"
    return types


# Defaults for missing values, and the known order statuses.
CUSTOMER_DEFAULTS = {
    "customer_name": "Unknown Customer",
    "email": "unknown@example.com",
    "country": "Unknown",
}
PRODUCT_DEFAULTS = {
    "product_name": "Unknown Product",
    "category": "Uncategorized",
    "price": 0.0,
}
ORDER_DEFAULTS = {
    "customer_id": -1,
    "product_id": -1,
    "order_date": "1970-01-01",
    "amount": 0.0,
    "status": "unknown",
}
DETAIL_DEFAULTS = {
    "customer_name": "Unknown Customer",
    "country": "Unknown",
    "product_name": "Unknown Product",
    "category": "Uncategorized",
}
STATUSES = ("completed", "cancelled", "pending", "unknown")
COMPLETED = "completed"
