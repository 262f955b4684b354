"""Orders with the names of their customer and product: ``order_details``.

Both joins are left joins on the key, so every order stays; a key that a
dimension holds twice gives two rows. No join is hinted: a dimension is
broadcast when its size allows it, else both sides are shuffled, and adaptive
execution splits a partition that one hot key (or the null key) makes too large.
That was the faster way when measured; ``hot_share``, which finds the hot keys
first and salts them, is for sessions in which adaptive execution cannot do it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.operators import clean

COLUMNS = ("order_id", "customer_name", "country", "product_name", "category", "amount", "status", "order_date")
CUSTOMER_COLUMNS = ("customer_name", "country")
PRODUCT_COLUMNS = ("product_name", "category")
#: Tasks that merge sketches before the last one does.
MERGES = 64


def with_customers(
    df: DataFrame, customers: DataFrame, columns: tuple[str, ...] = CUSTOMER_COLUMNS, hot: DataFrame | None = None
) -> DataFrame:
    """Left join of customers; ``hot`` as in ``salted_left_join``."""
    return _left_join(df, clean.standardize(customers, "customer").select("customer_id", *columns), "customer_id", hot)


def with_products(
    df: DataFrame, products: DataFrame, columns: tuple[str, ...] = PRODUCT_COLUMNS, hot: DataFrame | None = None
) -> DataFrame:
    """Left join of products; ``hot`` as in ``salted_left_join``."""
    return _left_join(df, clean.standardize(products, "product").select("product_id", *columns), "product_id", hot)


def order_details(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    filled: bool = True,
    hot_share: float | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Flatten the three inputs to ``columns``.

    ``filled`` gives unmatched names, countries and categories their defaults.
    ``unique_keys=True`` states that customer and product ids are unique; a
    dimension that adds no requested column is then not joined at all.
    Columns of the orders such as ``customer_id`` may be requested too.
    ``hot_share`` looks for hot keys at once, see ``hot_keys``.
    """
    needed = {
        key: (join, dimension, wanted)
        for key, join, dimension, wanted in (
            ("customer_id", with_customers, customers, tuple(c for c in CUSTOMER_COLUMNS if c in columns)),
            ("product_id", with_products, products, tuple(c for c in PRODUCT_COLUMNS if c in columns)),
        )
        if wanted or not unique_keys
    }
    hot = hot_keys(orders, list(needed), hot_share) if hot_share and needed else {}
    df = orders
    for key, (join, dimension, wanted) in needed.items():
        df = join(df, dimension, wanted, hot.get(key))
    df = df.select(*columns)
    return clean.fill(df, schemas.DETAIL_DEFAULTS) if filled else df


def _left_join(df: DataFrame, dimension: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    return df.join(dimension, key, "left") if hot is None else salted_left_join(df, dimension, key, hot)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_share: float) -> dict[str, DataFrame]:
    """Per column, the values with more than ``hot_share`` of the rows and their number of slices.

    Runs one pass over the key columns with a frequent-items sketch per task, so
    nothing is shuffled but the sketches; ``MERGES`` tasks merge them before one merges
    those, so no task's share grows with the number of partitions alone. A column has fewer than ``1 / hot_share``
    such values whatever the size of ``df``; a column without any is left out.
    The counts are estimates, but they only decide which rows are spread.
    """
    if not 1e-5 <= hot_share < 1:
        raise ValueError("hot_share must be at least 1e-5 and less than 1")
    limit = math.ceil(1 / hot_share)
    tracked = 8 * limit  # keeps the error of a count below half of hot_share
    sketched = df.groupBy((F.spark_partition_id() % MERGES).alias("_part")).agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias(key) for key in keys],
    )
    # A constant key, as a sum over everything fails in tasks without sketches.
    found = sketched.groupBy(F.lit("all")).agg(
        F.sum("_rows").alias("_rows"),
        *[F.expr(f"approx_top_k_estimate(approx_top_k_combine(`{key}`, {tracked}), {limit})").alias(key) for key in keys],
    ).first()
    slice_rows = found["_rows"] * hot_share
    hot = {
        key: [(item, math.ceil(count / slice_rows)) for item, count in found[key] if count > slice_rows] for key in keys
    }
    return {
        key: df.sparkSession.createDataFrame(
            values, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("_slices", T.IntegerType())])
        )
        for key, values in hot.items()
        if values
    }


def salted_left_join(df: DataFrame, dimension: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join in which the rows of every key listed by ``hot_keys`` are split.

    Only the dimension rows of hot keys are repeated, once per slice. The list is
    broadcast: ``hot_share`` bounds its length, and it is a fixed list by now, so
    both sides see the same one. The null key matches nothing, so its rows need
    no partner in the dimension.

    A row's slice follows from its values and its input partition, not from
    chance, so a task that runs again after a lost executor places it alike.
    """
    hot = F.broadcast(hot.withColumnRenamed(key, "_hot_key"))
    spread = F.xxhash64(F.spark_partition_id(), *df.columns)
    slices = F.coalesce("_slices", F.lit(1))
    left = (
        df.withColumn("_spread", spread)
        .join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_part", F.xxhash64(key, F.pmod("_spread", slices)))
        .drop("_spread", "_slices", "_hot_key")
    )
    right = (
        dimension.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        .select(
            F.col(key).alias("_key"), F.xxhash64(key, "_slice").alias("_part"), *[c for c in dimension.columns if c != key]
        )
    )
    # Rows are placed and sorted by the one number _part. The keys are compared as
    # well, in a form that does not make them part of the sort, which would be slow
    # for the many rows of a hot key.
    same_key = (left[key] <= right["_key"]) & (left[key] >= right["_key"])
    joined = left.join(right, (left["_part"] == right["_part"]) & same_key, "left")
    return joined.select(key, *[c for c in (*df.columns, *dimension.columns) if c != key])
