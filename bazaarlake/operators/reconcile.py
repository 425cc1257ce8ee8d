"""Reconciliation of two versions of a table that locates the rows that differ.

Every row has a bucket, from a hash of its key, and a checksum of all its columns. Sums
of checksums per bucket do not depend on the order or the place of rows. Only buckets
whose sums differ are looked into, key by key. Tables stored with ``with_bucket`` as
their partition column are read in those buckets alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
BUCKET = "key_bucket"


def _plain(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != BUCKET]


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the bucket of its key, to partition a stored table by."""
    number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets))
    return df.withColumn(BUCKET, number.cast("int"))


def _checksum(columns: Sequence[str]) -> Column:
    """NULLs and values at other places give other checksums."""
    parts = [F.coalesce(F.xxhash64(F.lit(i), F.col(c)), F.lit(i)) for i, c in enumerate(columns)]
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*parts, *nulls)


def _sums(columns: Sequence[str]) -> list[Column]:
    check = _checksum(columns)
    # A second, independent sum: equal changes of the first cannot cancel out in both.
    again = F.xxhash64(check, F.lit(1))
    return [
        F.count("*").alias("n"),
        F.sum(check.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(again).alias("xor"),
    ]


def checksums(bucketed: DataFrame) -> DataFrame:
    """Rows and checksums of each bucket: one row per bucket, folded in each task first."""
    return bucketed.groupBy(BUCKET).agg(*_sums(sorted(_plain(bucketed))))


def _apart(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns])
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    same_key = [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in on]
    differs = F.lit(False)
    for c in ("n", "sum", "xor"):
        differs = differs | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return left.join(right, same_key, "full_outer").filter(differs)


def differing_buckets(a: DataFrame, b: DataFrame) -> list[int]:
    """Numbers of the buckets that differ: at most as many as there are buckets."""
    apart = _apart(checksums(a), checksums(b), [BUCKET])
    return sorted(r[0] for r in apart.select(F.coalesce(f"a_{BUCKET}", f"b_{BUCKET}")).collect())


def table_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two bucketed tables, with ``status``.

    ``missing`` (in ``a`` only), ``extra`` (in ``b`` only) or ``changed``; several rows of
    a key are compared together, in any order. NULL keys are a key. Columns are matched
    by name and must be the same.
    """
    if sorted(_plain(a)) != sorted(_plain(b)):
        raise ValueError("the tables differ in their columns")
    where = F.col(BUCKET).isin(differing_buckets(a, b))
    columns = sorted(_plain(a))
    old, new = (t.filter(where).groupBy(*keys).agg(*_sums(columns)) for t in (a, b))
    status = F.when(F.col("b_n").isNull(), "missing").when(F.col("a_n").isNull(), "extra")
    named = [
        F.when(F.col("a_n").isNull(), F.col(f"b_{k}")).otherwise(F.col(f"a_{k}")).alias(k)
        for k in keys
    ]
    return _apart(old, new, keys).select(*named, status.otherwise("changed").alias("status"))
