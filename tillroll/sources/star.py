"""The star-schema tables as customers, products and orders.

One line item is one order row. The order headers are joined only when a column
of theirs is asked for, which is safe because their key is unique.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import session
from tillroll.functions import dates, money
from tillroll.operators import sums
from tillroll.sources import files

ORDER_COLUMNS = ("order_id", "customer_id", "product_id", "order_date", "amount", "status")
_HEADER = ("customer_id", "order_date", "status")

# The status codes are tested null-safely and one inside the other: Catalyst then
# folds "status = 'completed'" to a test of the code and pushes it into the scan.
_EXPRESSIONS = {
    "order_id": "l_orderkey",
    "line_number": "l_linenumber",
    "product_id": "l_partkey",
    "amount": "l_extendedprice",
    "customer_id": "o_custkey",
    "order_date": "CAST(o_orderdate AS DATE)",
    "status": "if(o_orderstatus <=> 'F', 'completed',"
    " if(o_orderstatus <=> 'O', 'pending', if(o_orderstatus <=> 'P', 'cancelled', 'unknown')))",
}

_schemas: dict[tuple[str, str, int], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A star table. Its schema is read once per application, again when the file or folder has changed."""
    path = posixpath.join(folder, f"{name}.parquet")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()
    key = (spark.sparkContext.applicationId, path, changed)
    df = files.read_parquet(spark, path, _schemas.get(key))
    _schemas.setdefault(key, df.schema)
    return df


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS name",
            "concat(lower(replace(c_name, '#', '_')), '@example.com') AS email",
            "n_name AS country",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS name", "p_type AS category", "p_retailprice AS price"
    )


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order key: order_id, customer_id, order_date, status."""
    return table(spark, folder, "orders").selectExpr("o_orderkey AS order_id", *_select(*_HEADER))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: order_id, product_id, amount."""
    return orders(spark, folder, ("order_id", "product_id", "amount"))


def orders(spark: SparkSession, folder: str, columns: tuple[str, ...] = ORDER_COLUMNS) -> DataFrame:
    """Order rows at line grain; ``line_number`` may be asked for as well."""
    df = table(spark, folder, "lineitem")
    if any(name in _HEADER for name in columns):
        df = df.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return df.selectExpr(*_select(*columns))


def window_start(spark: SparkSession, folder: str, days: int = 180, months: int | None = None) -> Column:
    """Start of the trailing window that ends at the newest order, for ``since`` of ``order_sums``.

    The tables hold zone-less timestamps, which Spark does not hand to the Parquet scan;
    data at rest that is to be read by date should be clustered by a DATE column.
    """
    return dates.trailing_start(table(spark, folder, "orders"), "o_orderdate", days, months)


def order_sums(spark: SparkSession, folder: str, since: Column | None = None) -> DataFrame:
    """Lines summed per order, with customer_id, order_date and status.

    Summing comes first, on the join's own key: no shuffle is added, each order
    is one row in it, and an order with very many lines is no hot key. Where the headers are small
    enough to be broadcast that shuffle is not needed at all: lines then stay lines, and
    the reports sum them by their own keys.
    ``since`` keeps orders from a date on. Headers are few then, so the lines are not
    summed first: the join comes with a runtime filter on them, or a broadcast.
    """
    lines, raw = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    same = F.col("l_orderkey") == F.col("o_orderkey")
    if since is None and session.fits_broadcast(raw.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")):
        return lines.join(raw, same, "left").selectExpr(*_select("order_id", *_HEADER, "amount"))
    if since is not None:
        header = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        recent = lines.join(raw.filter(F.col("o_orderdate") >= since), same)
        joined = sums.presum(recent, *header, amount="l_extendedprice").withColumnRenamed("o_orderkey", "l_orderkey")
    else:
        joined = sums.presum(lines, "l_orderkey", amount="l_extendedprice").join(raw, same, "left")
    return joined.selectExpr(*_select("order_id", *_HEADER), *money.COLUMNS, sums.ROWS)


def _select(*names: str) -> list[str]:
    return [f"{_EXPRESSIONS[name]} AS {name}" for name in names]
