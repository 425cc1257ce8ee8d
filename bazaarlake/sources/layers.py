"""Layered tables under one root folder on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlake.contracts import LAYERS
from bazaarlake.session import path_exists, replace_folder

DELTA_EXTENSION = "io.delta.sql.DeltaSparkSessionExtension"


@dataclass(frozen=True)
class Lake:
    """Tables addressed as (layer, name).

    Bronze, silver and gold are Delta tables where the session has Delta, else
    Parquet; platinum is always plain Parquet, readable by any query service.
    """

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}: expected one of {LAYERS}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def table_format(self, layer: str) -> str:
        extensions = self.spark.conf.get("spark.sql.extensions", "") or ""
        has_delta = DELTA_EXTENSION in extensions
        return "delta" if has_delta and layer != "platinum" else "parquet"

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        return self.spark.read.format(self.table_format(layer)).load(path)

    def exists(self, layer: str, table: str) -> bool:
        """Whether a write of the table ever succeeded; reads no data."""
        delta = self.table_format(layer) == "delta"
        mark = "_delta_log" if delta else "_SUCCESS"
        return path_exists(self.spark, f"{self.path(layer, table)}/{mark}")

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        *,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        dynamic: bool = False,
    ) -> int:
        """Write and return the row count, observed during the write itself.

        The number of files follows the plan's own partitions (AQE merges small
        ones); nothing is funnelled through one task. ``df`` must not read the
        table it overwrites: pass it through ``durable`` first.
        """
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.format(self.table_format(layer)).mode(mode)
        if self.table_format(layer) == "delta" and mode == "overwrite" and not dynamic:
            writer = writer.option("overwriteSchema", "true")
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(layer, table))
        return seen.get["rows"]

    def replace(self, df: DataFrame, layer: str, table: str) -> int:
        """Replace a table that ``df`` may read, in one write; returns the row count.

        Plain Parquet is written beside the table and then renamed; should that break
        off, the complete new table is in ``<table>.next``. Delta needs no such help.
        """
        if self.table_format(layer) == "delta":
            return self.write(df, layer, table)
        rows = self.write(df, layer, f"{table}.next")
        place = self.path(layer, table)
        replace_folder(self.spark, f"{place}.next", place)
        return rows

    def write_all(
        self, tables: Mapping[str, DataFrame], layer: str, names: Sequence[str] = ()
    ) -> dict[str, int]:
        return {
            name: self.write(tables[name], layer, name)
            for name in tables
            if not names or name in names
        }


def with_period(df: DataFrame, date_key: str = "purchase_date_key") -> DataFrame:
    """Add ``year`` and ``month`` of an integer date key, to partition by."""
    key = F.col(date_key)
    return df.withColumns(
        {
            "year": F.floor(key / 10000).cast("int"),
            "month": (F.floor(key / 100) % 100).cast("int"),
        }
    )


def clustered(
    df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]
) -> DataFrame:
    """Lay rows out so that files cover narrow ranges of the cluster columns.

    Ranges are cut on partition *and* cluster columns, so a month with a third
    of the rows spreads over many files; readers skip files by their min/max
    statistics.
    """
    columns = [*partition_by, *cluster_by]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
