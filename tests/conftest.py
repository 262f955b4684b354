from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tillroll import schemas, session  # noqa: E402


def pytest_addoption(parser):
    parser.addoption("--golden", help="folder with published inputs and results as CSV")


@pytest.fixture(scope="session")
def spark():
    spark = session.build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def make(spark):
    """Small inputs: rows of customers, products, orders or order details."""

    def build(kind: str, rows: list[tuple]):
        schema = {
            "customers": schemas.customers(),
            "products": schemas.products(),
            "orders": schemas.orders(),
            "details": schemas.order_details(),
        }[kind]
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
