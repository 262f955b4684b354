"""The tables the registered queries read, and small pieces several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import session

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    session.ship(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def words(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column, null: str | None = "") -> Column:
    """Lower-case A-Z and nothing else; null counts as ``null``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text if null is None else F.coalesce(text, F.lit(null)), upper, upper.lower())
