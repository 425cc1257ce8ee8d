"""Upserts into stored tables.

A plain Parquet table has no transaction and cannot be overwritten while it is
read. The merged rows are therefore written beside it and take its place by a
rename. Where a table has partitions, only those with new rows are written: Spark
stages their files and moves them in at commit. A Delta table merges in its own
transaction. See ``bucketed`` for tables whose merges touch single buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from bazaarlake.contracts import Contract
from bazaarlake.operators.upsert import upsert, upsert_partitions
from bazaarlake.sources.layers import Lake


def merge(
    lake: Lake, contract: Contract, fresh: DataFrame, layer: str = "bronze"
) -> int:
    """Upsert ``fresh`` by the contract's keys; returns the table's row count."""
    if not lake.exists(layer, contract.name):
        return lake.write(fresh, layer, contract.name)
    if lake.table_format(layer) == "delta":
        return _delta_merge(lake, contract, fresh, layer)
    merged = upsert(lake.read(layer, contract.name), fresh, contract.keys)
    return lake.replace(merged, layer, contract.name)


def merge_partitions(
    lake: Lake,
    layer: str,
    table: str,
    fresh: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
) -> int:
    """Upsert into a partitioned table, rewriting only partitions with new rows.

    Returns the rows written. The partition of an existing key must not change.
    """
    target = lake.read(layer, table)
    changed = upsert_partitions(target, fresh, keys, partition_by)
    return lake.write(changed, layer, table, partition_by=partition_by, dynamic=True)


def _delta_merge(lake: Lake, contract: Contract, fresh: DataFrame, layer: str) -> int:
    on = " AND ".join(f"t.{k} = s.{k}" for k in contract.keys)
    lake.spark.sql(
        f"""MERGE INTO delta.`{lake.path(layer, contract.name)}` t
            USING {{source}} s ON {on}
            WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *""",
        source=fresh,
    )
    return lake.read(layer, contract.name).count()
