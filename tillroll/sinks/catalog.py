"""Databases and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas

MODES = ("append", "overwrite")


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a database unless it exists; its tables live under ``location``."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def create_table(
    spark: SparkSession,
    table: str,
    types: dict[str, str],
    recreate: bool = False,
    partitioned_by: Sequence[str] = (),
) -> None:
    """Create a Parquet table with declared types unless it exists; ``recreate`` drops it first.

    Columns of ``partitioned_by`` are the last ones.
    """
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts}")


def create_tables(spark: SparkSession, database: str, wide: bool = True, recreate: bool = False) -> None:
    """The five output tables; ``wide`` as in ``schemas.table_types``."""
    for name in schemas.OUTPUT_TABLES:
        create_table(spark, f"{database}.{name}", schemas.table_types(name, wide), recreate)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write a table whose rows lie by ``key`` in so many sorted files, and return it.

    Tables with as many buckets of one key meet in a join, or are grouped by it, without being
    shuffled. Rows are dealt by the same hash first, so a bucket is one file. For large
    tables take about their size over 256 MB; a key with a third of all rows makes one large bucket.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def write_table(df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Load a table that exists, in parallel, matching columns by name.

    Values are cast to the declared types; text too long or numbers too large
    raise. ``append`` adds to the rows there, also when the same load runs twice.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=mode == "overwrite")
