"""Marts as external tables of a catalog database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.contracts import PLATINUM
from bazaarlake.sources.layers import Lake


def create_database(spark: SparkSession, database: str, location: str | None = None):
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def register(lake: Lake, database: str, names: Sequence[str] = tuple(PLATINUM)) -> None:
    """Create the tables, or point existing ones at the current contract.

    The data is external: dropping or redefining a table leaves the files.
    """
    create_database(lake.spark, database)
    for name in names:
        columns = PLATINUM[name].ddl
        location = lake.path("platinum", name)
        table = f"{database}.{name}"
        if lake.spark.catalog.tableExists(table):
            if _matches(lake.spark, table, PLATINUM[name].schema, location):
                continue  # readers and views see no gap
            lake.spark.sql(f"DROP TABLE {table}")
        lake.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{location}'"
        )


def _matches(spark: SparkSession, table: str, schema, location: str) -> bool:
    """Whether the table has these columns at this place."""
    found = [(f.name, f.dataType) for f in spark.table(table).schema]
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    place = facts.first()
    if place is None or found != [(f.name, f.dataType) for f in schema]:
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    full = lambda p: path(p).getFileSystem(conf).makeQualified(path(p)).toString()
    return full(place["data_type"]) == full(location)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of every table in the database."""
    rows = [
        (table.name, position, column.name, column.dataType)
        for table in spark.catalog.listTables(database)
        if table.tableType == "EXTERNAL"
        for position, column in enumerate(
            spark.catalog.listColumns(f"{database}.{table.name}"), start=1
        )
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string"
    ).orderBy("table_name", F.asc("position"))


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop the database with the tables and views registered in it."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
