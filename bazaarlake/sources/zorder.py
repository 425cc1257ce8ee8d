"""Files clustered on several columns at once.

Rows are laid out along a Z-order curve over the columns' ranks: each column is cut
into equally filled buckets, and the bits of the bucket numbers take turns in the sort
key. A file then covers a narrow range of every column, not of the first one only, and
readers skip files by their min/max statistics for a filter on any of them.

The cuts come from a bounded random sample of rows. They decide where rows lie, never
what a query returns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def bucket_cuts(df: DataFrame, columns: Sequence[str], bits: int, sample_rows: int = SAMPLE_ROWS) -> list[list]:
    """Per column, the at most ``2 ** bits - 1`` values that begin a new bucket."""
    picked = df.select(*columns).orderBy(F.rand(7)).limit(sample_rows).collect()
    cuts = []
    for i in range(len(columns)):
        values = sorted(row[i] for row in picked if row[i] is not None)
        places = [len(values) * n // 2**bits for n in range(1, 2**bits)]
        cuts.append(sorted({values[p] for p in places}) if values else [])
    return cuts


def bucket_number(value: Column, cuts: Sequence, first: int = 0) -> Column:
    """How many of the sorted cuts ``value`` reaches, by binary search in generated code."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(
        value < F.lit(cuts[middle]), bucket_number(value, cuts[:middle], first)
    ).otherwise(bucket_number(value, cuts[middle + 1 :], first + middle + 1))


def with_bucket_numbers(df: DataFrame, columns: Sequence[str], cuts: Sequence[Sequence], bits: int) -> DataFrame:
    """``df`` with ``_bucket0``, ``_bucket1``, ...: ``bucket_number`` of each column, 0 for NULL.

    A step of the search is a column of its own over an array of the cuts. The generated
    code stays small enough for the JVM to compile, as a tree of all cuts does not.
    """
    for place, (column, cut) in enumerate(zip(columns, cuts, strict=True)):
        name = f"_bucket{place}"
        df = df.withColumn(name, F.lit(0))
        if not cut:
            continue
        values = F.array(*map(F.lit, cut))
        for bit in reversed(range(bits)):
            reached = F.get(values, F.col(name) + (2**bit - 1)) <= F.col(column)
            step = F.when(F.coalesce(reached, F.lit(False)), 2**bit).otherwise(0)
            df = df.withColumn(name, F.col(name) + step)
    return df


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of all numbers in turn, highest first."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - place))
    return key


def z_ordered(
    df: DataFrame,
    columns: Sequence[str],
    *,
    bits: int = 8,
    files: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """``df`` in ranges along the curve over ``columns``; NULLs lie in the first bucket.

    Rows of one place on the curve are spread by a hash of the columns, so that a
    frequent combination can fill many files. ``files`` fixes the number of ranges;
    else it follows the shuffle partitions and AQE.
    """
    cuts = bucket_cuts(df, columns, bits)
    placed = with_bucket_numbers(df, columns, cuts, bits)
    numbers = [f"_bucket{place}" for place in range(len(columns))]
    keyed = placed.withColumn("_z", interleaved([F.col(n) for n in numbers], bits)).drop(*numbers)
    order = [*partition_by, "_z", *columns]
    ranges = keyed.repartitionByRange(*([files] if files else []), *order)
    return ranges.sortWithinPartitions(*order).drop("_z")


def files_met(df: DataFrame, column: str, probes: Sequence) -> DataFrame:
    """What a filter on one value has to open: ``value files all_files`` for each probe.

    A file is met if its min/max range holds the value. ``df`` must be a stored table;
    its files' ranges are one row each, and are counted for all probes at once.
    """
    spans = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    kind = df.schema[column].dataType
    met = [
        F.struct(
            F.lit(value).cast(kind).alias("value"),
            F.count_if(F.lit(value).between(F.col("low"), F.col("high"))).alias("files"),
            F.count("*").alias("all_files"),
        )
        for value in probes
    ]
    return spans.agg(F.array(*met).alias("met")).select(F.inline("met"))
