import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bazaarlake.session import tune  # noqa: E402
from bazaarlake.sources.layers import Lake  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def table(spark):
    """Build a DataFrame: DDL text, then rows as tuples."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture(scope="session")
def rows():
    """All rows as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
