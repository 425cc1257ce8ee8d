"""Percentiles of whole numbers: exact from histograms, and from mergeable sketches.

The p-th percentile is the smallest value that at least p in 100 of the values do not
exceed (nearest rank), so both forms return values that occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries of a sketch's first level. The rank of a quantile is off by at most
#: RANK_ERROR of all values, with 99 % confidence.
SKETCH_K = 200
RANK_ERROR = 0.0165


def percentile_columns(shares: Sequence[int]) -> list[str]:
    return [f"p{share}" for share in shares]


def exact_percentiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Sequence[int] = (50, 90, 99)
) -> DataFrame:
    """``by``, ``values_n`` and a column per share; NULL values do not count.

    Rows shrink to one per group and distinct value before the shuffle; a window then
    runs over a group's distinct values.
    """
    histogram = (
        df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    )
    group = Window.partitionBy(*by)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = histogram.withColumns(
        {"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(group)}
    )
    reached = [F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * s, F.col(value))) for s in shares]
    return placed.groupBy(*by).agg(
        F.max("_all").alias("values_n"),
        *[r.alias(name) for r, name in zip(reached, percentile_columns(shares), strict=True)],
    )


def sketch_of(value: str, k: int = SKETCH_K) -> Column:
    """Aggregate: a quantile sketch of a whole-number column."""
    return F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k)


def merged(sketch: str) -> Column:
    """Aggregate: one sketch of many."""
    return F.kll_merge_agg_bigint(sketch)


def sketched_percentiles(sketch: Column | str, shares: Sequence[int] = (50, 90, 99)) -> list[Column]:
    """A column per share, within RANK_ERROR of its rank."""
    found = F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(s / 100) for s in shares]))
    return [found[i].alias(name) for i, name in enumerate(percentile_columns(shares))]
