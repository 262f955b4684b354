"""CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import session
from tillroll.sources.files import CSV_OPTIONS

# Blanks around a value are part of it.
_WRITE_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = False) -> None:
    """Write a folder of CSV files with headers, in parallel.

    An empty result is written as a header. With ``skip_empty`` it is not written,
    and whatever the folder held before stays; the result is then staged, so that
    looking for a row does not compute it a second time.
    """
    if skip_empty:
        with session.temporary(df, "csv") as staged:
            if not staged.isEmpty():
                write_csv(staged, path, mode)
        return
    df.write.mode(mode).options(**_WRITE_OPTIONS).csv(path)


def write_one_csv(df: DataFrame, path: str, order_by: tuple = ()) -> None:
    """Write a result as a folder with one CSV file, sorted by ``order_by`` or else in the order it has.

    The result is computed in parallel and staged; one task then copies it, whatever
    its size. That is what one file means: ask for it where a report is small.
    """
    with session.temporary(df.withColumn("_place", F.monotonically_increasing_id()), "one-csv") as staged:
        one = staged.coalesce(1).sortWithinPartitions(*order_by, "_place").drop("_place")
        one.write.mode("overwrite").options(**_WRITE_OPTIONS).csv(path)
