"""Loads that can be run again, and reports that stay true over all of them.

A load is written under an id of its own attempt: ``order_details`` by month, and of each
report the sums it is made of. Only when all tables have it is the list of attempts
replaced, one statement for all tables, so readers see the whole load or nothing of
it, and a load that runs twice is there once. Sums of several loads add up, so a report
reads a row per group and load, not the orders.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas, session
from tillroll.functions import dates, money
from tillroll.operators import reports, sums
from tillroll.sinks import catalog

#: What the tables are partitioned by; order_details by month as well.
LOAD, ATTEMPT, MONTH = "load_id", "attempt", "order_month"
_PARTS = {name: "BIGINT" for name in (*money.COLUMNS, sums.ROWS)}
#: Of each table of sums, the grouping columns and their types.
SUMS = {
    "customer_sums": {"customer_name": "STRING", "country": "STRING"},
    "month_sums": {"order_date": "DATE"},
    "category_sums": {"category": "STRING"},
    "status_sums": {"status": "STRING"},
}
_ID = re.compile(r"[A-Za-z0-9._-]{1,100}")


class Loads:
    """The tables and views of one database. One load is written at a time; any number may read."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None) -> None:
        self.spark, self.database = spark, database
        catalog.ensure_database(spark, database, location)
        details = schemas.table_types("order_details") | {LOAD: "STRING", ATTEMPT: "STRING", MONTH: "DATE"}
        self._create("order_details", details, (LOAD, ATTEMPT, MONTH))
        for name, keys in SUMS.items():
            self._create(name, keys | _PARTS | {LOAD: "STRING", ATTEMPT: "STRING"}, (LOAD, ATTEMPT))
        self._create("load_facts", {"newest": "DATE", LOAD: "STRING", ATTEMPT: "STRING"}, (LOAD, ATTEMPT))
        if not spark.catalog.tableExists(f"{database}.published"):
            self._publish({})

    def _create(self, name: str, types: dict[str, str], partitions: tuple[str, ...]) -> None:
        catalog.create_table(self.spark, f"{self.database}.{name}_loads", types, partitioned_by=partitions)

    def load(self, details: DataFrame, load_id: str) -> None:
        """Write a load and publish it; one of the same id is replaced.

        Whatever fails before the end leaves all views as they were. Details are written first,
        dealt by month so that a month is a few large files also where one has most of the
        rows; the sums are computed from what was written.
        """
        if not _ID.fullmatch(load_id):
            raise ValueError("a load id has up to 100 letters, digits, dots, dashes and underscores")
        attempt = uuid.uuid4().hex
        month = dates.month_start("order_date").alias(MONTH)
        self._append("order_details", details.select("*", month).hint("rebalance", MONTH), load_id, attempt)
        written = self.spark.table(f"{self.database}.order_details_loads").filter(F.col(ATTEMPT) == attempt)
        for name, summed in self._sums(written).items():
            self._append(name, summed, load_id, attempt)
        self._append("load_facts", written.agg(F.max("order_date").alias("newest")), load_id, attempt)
        self._publish(self.published() | {load_id: attempt})

    @staticmethod
    def _sums(details: DataFrame) -> dict[str, DataFrame]:
        done = reports.completed(details)
        return {
            "customer_sums": sums.presum(done, "customer_name", "country"),
            "month_sums": sums.presum(done.withColumn("order_date", dates.month_start("order_date")), "order_date"),
            "category_sums": sums.presum(done, "category"),
            "status_sums": sums.presum(details, "status"),
        }

    def _append(self, name: str, df: DataFrame, load_id: str, attempt: str) -> None:
        marked = df.withColumns({LOAD: F.lit(load_id), ATTEMPT: F.lit(attempt)})
        catalog.write_table(marked, f"{self.database}.{name}_loads", "append")

    def published(self) -> dict[str, str]:
        """Load ids and the attempts that are seen: a row per load."""
        return {row[LOAD]: row[ATTEMPT] for row in self.spark.table(f"{self.database}.published").collect()}

    def _publish(self, attempts: dict[str, str]) -> None:
        rows = ", ".join(f"('{load}', '{attempt}')" for load, attempt in sorted(attempts.items()))
        source = f"VALUES {rows}" if rows else "VALUES ('', '') LIMIT 0"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.published ({LOAD}, {ATTEMPT}) AS {source}")

    def withdraw(self, load_id: str) -> None:
        """Take a load out of all tables at once."""
        self._publish({load: attempt for load, attempt in self.published().items() if load != load_id})

    def table(self, name: str) -> DataFrame:
        """The rows of all published loads, with the load id.

        The attempts are one scalar, so partitions of others are not read.
        """
        seen = self.spark.table(f"{self.database}.published").agg(F.collect_list(ATTEMPT)).scalar()
        return self.spark.table(f"{self.database}.{name}_loads").filter(F.array_contains(seen, F.col(ATTEMPT))).drop(ATTEMPT)

    def order_details(self, since: Column | None = None) -> DataFrame:
        """Published orders, on request from a date on: earlier months are then not read."""
        df = self.table("order_details")
        if since is not None:
            df = df.filter((F.col(MONTH) >= F.trunc(since, "MM")) & (F.col("order_date") >= since))
        return df.drop(LOAD, MONTH)

    def window_start(self, days: int = 180, months: int | None = None) -> Column:
        """First day of the trailing window that ends at the newest order of any load."""
        return dates.trailing_start(self.table("load_facts"), "newest", days, months)

    def report(self, name: str, **options) -> DataFrame:
        """A report over all loads from their sums; options as in ``reports``.

        ``monthly_revenue`` of a window that begins inside a month needs ``order_details(since)``.
        """
        source, report = {
            "top_customers": ("customer_sums", reports.top_customers),
            "monthly_revenue": ("month_sums", reports.monthly_revenue),
            "popular_categories": ("category_sums", reports.popular_categories),
            "order_status": ("status_sums", reports.order_status),
        }[name]
        df = self.table(source)
        return report(df if name == "order_status" else df.withColumn("status", F.lit(schemas.COMPLETED)), **options)

    def remove_unpublished(self, remove: Callable[[SparkSession, str], None] = session.remove) -> list[str]:
        """Delete what failed and replaced attempts have left; returns their folders. Nobody may be reading them."""
        seen = set(self.published().values())
        found = []
        for name in ("order_details", *SUMS, "load_facts"):
            table = f"{self.database}.{name}_loads"
            place = next(r["data_type"] for r in self.spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["col_name"] == "Location")
            pattern = self.spark._jvm.org.apache.hadoop.fs.Path(posixpath.join(place, f"{LOAD}=*", f"{ATTEMPT}=*"))
            listed = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
            old = [str(f.getPath()) for f in listed if str(f.getPath()).rsplit("=", 1)[1] not in seen]
            for path in old:
                remove(self.spark, path)
            found += old
            self.spark.catalog.refreshTable(table)
        return found
