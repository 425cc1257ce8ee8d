"""Keyed upsert as a DataFrame plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DUPLICATE_SOURCE = "several source rows match one target row on "
MOVED_ROW = "a source row would move its target row to another partition: "


def refuse(rows: DataFrame, message: str, like: DataFrame) -> DataFrame:
    """No rows of ``like``'s schema, or an error at run time if ``rows`` has any.

    Added to a result with a union, it checks the data while the result is
    computed: no extra job and nothing collected. The error hangs on a count,
    so that no optimizer rule can move it below the conditions in ``rows``.
    """
    found = F.when(F.col("_n") > 0, F.raise_error(F.lit(message)))
    return (
        rows.agg(F.count("*").alias("_n"))
        .filter(found.isNotNull())
        .select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields]
        )
    )


def as_target(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source rows with the target's columns and types."""
    missing = [n for n in target.columns if n not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {', '.join(missing)}")
    return source.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after replacing matched rows and inserting the others.

    Rows match when every key is equal; a NULL key matches nothing, so such
    source rows are inserted. Two source rows for one existing key are an
    error, raised when the result is computed. The target is shuffled only if
    the source is too large to broadcast (Spark decides by measured size).
    """
    keys = list(keys)
    rows = as_target(target, source)
    return kept_rows(target, rows, keys).unionByName(rows)


def kept_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that no source row replaces; the target is read once.

    Source rows are counted per key, so a target row meets one row at most.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    several = F.raise_error(F.lit(DUPLICATE_SOURCE + ", ".join(keys))).cast("boolean")
    unmatched = F.when(F.col("_n") > 1, several).otherwise(F.col("_n").isNull())
    return target.join(counted, list(keys), "left").filter(unmatched).select(*target.columns)


def upsert_partitions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
) -> DataFrame:
    """The upserted rows of only those partitions the source has rows for.

    Other partitions are read for their keys alone, to refuse source rows
    whose existing row sits in a different partition.
    """
    keys, partition_by = list(keys), list(partition_by)
    rows = as_target(target, source)
    touched = rows.select(*partition_by).distinct()
    affected = target.join(touched, partition_by, "left_semi").select(*target.columns)
    incoming = rows.select(
        *keys, *[F.col(p).alias(f"_new_{p}") for p in partition_by if p not in keys]
    )
    changed = F.lit(False)
    for p in partition_by:
        if p not in keys:
            changed = changed | ~F.col(p).eqNullSafe(F.col(f"_new_{p}"))
    moved = target.join(incoming, keys).filter(changed)
    return upsert(affected, rows, keys).unionByName(
        refuse(moved, MOVED_ROW + ", ".join(partition_by), like=target)
    )
