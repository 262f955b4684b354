"""Cleaning of the three inputs.

``fill`` replaces missing values by defaults and drops orders with an unlisted
status; ``drop`` drops every order with a missing value and leaves statuses
alone. Missing means null, and for numbers NaN as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import dates

POLICIES = ("fill", "drop", "none")


def fill(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Defaults for the columns that ``df`` has; others are left out."""
    return df.fillna({name: value for name, value in defaults.items() if name in df.columns})


def is_present(df: DataFrame, name: str) -> Column:
    present = F.col(name).isNotNull()
    return present & ~F.isnan(name) if dict(df.dtypes)[name] in ("double", "float") else present


def standardize(df: DataFrame, prefix: str) -> DataFrame:
    """Rename ``name`` to ``customer_name`` or ``product_name``, so the two cannot clash."""
    return df.withColumnRenamed("name", f"{prefix}_name")


def customers(df: DataFrame, policy: str = "fill") -> DataFrame:
    _check(policy)
    df = standardize(df, "customer")
    return fill(df, schemas.CUSTOMER_DEFAULTS) if policy == "fill" else df


def products(df: DataFrame, policy: str = "fill") -> DataFrame:
    _check(policy)
    df = standardize(df, "product")
    return fill(df, schemas.PRODUCT_DEFAULTS) if policy == "fill" else df


def one_per_key(df: DataFrame, key: str, prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key, so that a join on it does not multiply the other side.

    The row with the greatest ``prefer`` stays, then the one with most values present, then the greatest
    by its columns in order. Rows are compared where they are before they move, so a
    key that has very many rows is one row per task. Rows without a key become one.
    """
    others = [name for name in df.columns if name != key]
    present = reduce(add, [is_present(df, name).cast("int") for name in others], F.lit(0))
    best = F.max_by(F.struct(*others), F.struct(*prefer, present, *others))
    return df.groupBy(key).agg(best.alias("_best")).select(*[f"_best.{c}" if c != key else key for c in df.columns])


def orders(df: DataFrame, policy: str = "fill", fill_keys: bool = True) -> DataFrame:
    """Clean orders; the date becomes a date, null where the text is malformed.

    With ``fill_keys=False`` missing customer and product ids stay null: no
    dimension row has the id -1, so a later join gives the same either way, but
    the -1 rows would all meet in one task of it.
    """
    _check(policy)
    if policy == "drop":
        # One test per column, not na.drop(): these reach the scan as pushed filters.
        df = df.filter(reduce(and_, [is_present(df, name) for name in df.columns]))
    if policy == "fill":
        df = df.filter(
            F.col("order_id").isNotNull() & (F.col("status").isNull() | F.col("status").isin(*schemas.STATUSES))
        )
        defaults = dict(schemas.ORDER_DEFAULTS)
        df = df.withColumn("status", _listed_status(defaults.pop("status")))
        if not fill_keys:
            del defaults["customer_id"], defaults["product_id"]
        df = fill(df, defaults)
    return df.withColumn("order_date", dates.parse(F.col("order_date")))


def _listed_status(default: str) -> Column:
    """The status where it is listed, else the default: only missing ones are left to get it.

    One null-safe test per status, one inside the other with the first status
    outermost: Catalyst then folds a later ``status = 'completed'`` to a test of
    the raw column, which the scan gets.
    """
    status = F.lit(default)
    for listed in reversed(schemas.STATUSES):
        if listed != default:
            status = F.when(F.col("status").eqNullSafe(listed), listed).otherwise(status)
    return status


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
