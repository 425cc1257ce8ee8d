"""Tables bucketed by key, so that an increment shuffles and rewrites only itself.

A bucket is a hash of the key: the one Spark's own bucketing uses. It is stored twice
over, as a folder and as Spark's bucket number. The folder lets a merge read and
replace the touched buckets alone; the bucket number lets the join take the stored
rows as they lie, without an exchange. The increment is shuffled to them.

A merge replaces the touched folders in one write: Spark stages the new files and
moves them in when the job commits. Untouched buckets keep their files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.contracts import Contract
from bazaarlake.operators.upsert import as_target, kept_rows
from bazaarlake.sources.catalog import create_database
from bazaarlake.sources.layers import Lake

BUCKET = "key_bucket"


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table in ``database`` over files in the lake's ``layer``."""

    lake: Lake
    contract: Contract
    database: str
    buckets: int = 64
    layer: str = "bronze"

    @property
    def name(self) -> str:
        return f"{self.database}.{self.contract.name}"

    @property
    def _keys(self) -> list[str]:
        return list(self.contract.keys)

    def _numbered(self, rows: DataFrame) -> DataFrame:
        number = F.pmod(F.hash(*self._keys), F.lit(self.buckets))
        return rows.withColumn(BUCKET, number)

    def create(self, rows: DataFrame) -> None:
        """Write ``rows`` as the table, one shuffle by key."""
        create_database(self.lake.spark, self.database, f"{self.lake.root}/{self.database}")
        laid_out = self._numbered(rows.select(*self.contract.columns))
        (
            laid_out.repartition(self.buckets, *self._keys)
            .write.format("parquet")
            .mode("overwrite")
            .partitionBy(BUCKET)
            .bucketBy(self.buckets, *self._keys)
            .sortBy(*self._keys)
            .option("path", self.lake.path(self.layer, f"{self.contract.name}_bucketed"))
            .saveAsTable(self.name)
        )

    def read(self) -> DataFrame:
        return self.lake.spark.table(self.name).drop(BUCKET)

    def merged(self, fresh: DataFrame) -> DataFrame:
        """The touched buckets after the upsert; the stored rows meet no exchange."""
        rows = self._numbered(as_target(self.read(), fresh)).repartition(self.buckets, *self._keys)
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most ``buckets``
        stored = self.lake.spark.table(self.name).filter(F.col(BUCKET).isin(touched))
        return kept_rows(stored, rows, self._keys).unionByName(rows)

    def merge(self, fresh: DataFrame) -> int:
        """Upsert by key; returns the table's row count, read from file footers."""
        if not fresh.isEmpty():
            with _touched_folders_only(self.lake.spark):
                self.merged(fresh).write.insertInto(self.name, overwrite=True)
        return self.read().count()


@contextmanager
def _touched_folders_only(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it has rows for. An insert into a catalog
    table takes that from the session only; the session gets its own mode back."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)
