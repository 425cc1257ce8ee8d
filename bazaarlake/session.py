"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings only, so they can be applied to a session that the
# caller already started. A join key that holds a large share of the rows is
# split at run time by AQE; the "force" flag lets that happen even where the
# split costs one more exchange for the operator above the join.
SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# AQE merges shuffle partitions up to this size. A row of the retail tables takes many
# times its compressed bytes in the sorts and hash tables of a stage of several joins.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def tune(spark: SparkSession, *more: Mapping[str, str]) -> SparkSession:
    """Apply the run-time settings the plans are designed for, and ``more``."""
    for settings in (SKEW_CONF, *more):
        for key, value in settings.items():
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run-time settings for the length of a ``with`` block; the session gets its own back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session that names none (a test) gets a private folder. On a
    cluster a folder of the driver's machine would lose data without a word.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            master = getattr(context, "master", "local")
            if not master.startswith("local") or "cluster" in master:
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder that all executors share"
                )
            context.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarlake-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never handed out twice."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage the way a reliable checkpoint does and, being a plain
    table in shared storage, survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _location(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system ``path`` names."""
    files, location = _location(spark, path)
    return files.exists(location)


def replace_folder(spark: SparkSession, source: str, place: str) -> None:
    """Put folder ``source`` where ``place`` is, by renaming."""
    files, new = _location(spark, source)
    _, old = _location(spark, place)
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{source} could not be moved to {place}; it is complete")


@contextmanager
def passing(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``durable(df)`` for the length of a ``with`` block.

    The copy is removed when the block succeeds. If it fails the copy stays,
    so that a result whose final write broke off is not lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    files, location = _location(spark, path)
    files.delete(location, True)
