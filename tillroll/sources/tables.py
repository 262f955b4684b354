"""Catalog tables, temp views, SQL text and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register(df: DataFrame, name: str = "order_details") -> None:
    """Name a DataFrame for SQL. The view is lazy: nothing is copied."""
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text. DataFrames named in ``frames`` are used as ``{name}`` in the text."""
    return spark.sql(text, **frames)


def jdbc_options(
    url: str,
    table: str,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Reader options; ``partition`` is (column, lower, upper, parts).

    The bounds only set the stride; rows outside them are read too. Without a
    partition column one task reads the whole table, so give one for anything
    large. Credentials come from the caller through ``more``.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **more}
    if partition is not None:
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
