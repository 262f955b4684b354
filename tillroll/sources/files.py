"""CSV and Parquet readers with declared schemas."""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas

# Quotes inside a value are doubled, as pandas and spreadsheets write them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Nothing is inferred, so the file is read once.

    Malformed numbers and empty fields become null. ``multi_line`` is needed only
    for values with line breaks; such files cannot be split.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the declared schema, typed, and the others as text with ``line`` and ``reasons``.

    ``reasons`` lists ``columns`` where a line has too few or too many of them, with the line as it
    was read, and each column whose text is no value of its type. Empty fields are null and fit. A header that
    names other columns than the schema, or names them in another order, raises when it is read.
    """
    text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names] + [T.StructField("line", T.StringType())])
    options = CSV_OPTIONS | {"header": header, "enforceSchema": not header, "columnNameOfCorruptRecord": "line"}
    raw = spark.read.schema(text).options(**options).csv(path)
    typed = {field.name: F.col(field.name).try_cast(field.dataType) for field in schema}
    wrong = [F.when(F.col("line").isNotNull(), "columns")]
    wrong += [F.when(F.col(name).isNotNull() & value.isNull(), name) for name, value in typed.items()]
    marked = raw.withColumn("reasons", F.array_compact(F.array(*wrong)))
    fitting = marked.filter(F.size("reasons") == 0).select(*[value.alias(name) for name, value in typed.items()])
    return fitting, marked.filter(F.size("reasons") > 0)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet holds its schema; giving it saves the job that reads a footer for it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``customers.csv``, ``products.csv`` and ``orders.csv`` of a folder, in that order."""
    return tuple(
        read_csv(spark, posixpath.join(folder, f"{name}.csv"), schema)
        for name, schema in (
            ("customers", schemas.customers()),
            ("products", schemas.products()),
            ("orders", schemas.orders()),
        )
    )


def csv_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Which result files exist and how many rows they hold: name, present, row_count."""
    report = None
    for name, path in paths.items():
        try:
            rows = spark.read.options(**CSV_OPTIONS).schema("line STRING").csv(path)
            one = rows.agg(F.lit(name).alias("name"), F.lit(True).alias("present"), F.count("*").alias("row_count"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            one = spark.range(1).select(
                F.lit(name).alias("name"),
                F.lit(False).alias("present"),
                F.lit(None).cast("bigint").alias("row_count"),
            )
        report = one if report is None else report.unionByName(one)
    return report
