"""Exact ranks, running totals and quantile cuts without one big window.

A window without partition keys sends every row to one task. These helpers
rank *values* instead of rows, in levels:

1. ``histogram``: rows per distinct value (partial aggregation, so a value
   held by a third of the rows is reduced before the shuffle);
2. values are grouped into ranges of ``width`` whole numbers, and those into
   groups of ``width`` ranges. A window over the values of a range, or over the
   ranges of a group, has at most ``width`` rows however many there are in all
   and however sparse they lie. Of groups there are at most ``2 ** 64 / width ** 2``,
   which the one window over all groups sees: 4 million for the default width.

Values must be integers (counts, cents, days). Ties share a rank, as in
``rank()``, ``dense_rank()`` and a RANGE running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct values per range, and ranges per group: the most rows of a window group.
RANGE_WIDTH = 1 << 21


def value_ranks(
    df: DataFrame,
    value: str,
    *,
    descending: bool = False,
    total: str | None = None,
    width: int = RANGE_WIDTH,
) -> DataFrame:
    """One row per distinct non-NULL ``value`` with its place in the order.

    ``rank_no``      rank() of the value among all rows
    ``dense_rank_no`` dense_rank() of the value
    ``row_count``    rows holding the value
    ``running_total`` sum of the integer column ``total`` up to and including
    the value (only when ``total`` is given)
    """
    measures = [F.count("*").alias("row_count")]
    if total:
        measures.append(F.sum(total).cast("decimal(38,0)").alias("_sum"))
    histogram = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(*measures)
        .withColumn("_range", F.floor(F.col(value) / width))
    )

    def order(column: str):
        return F.desc(column) if descending else F.asc(column)

    sums = ["_rows", "_values", *(["_total"] if total else [])]

    def before(window) -> list[Column]:
        """Of each sum, what comes earlier in the window."""
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums]

    per_range = [
        F.sum("row_count").alias("_rows"),
        F.count("*").alias("_values"),
        *([F.sum("_sum").alias("_total")] if total else []),
    ]
    ranges = (
        histogram.groupBy("_range")
        .agg(*per_range)
        .withColumn("_group", F.floor(F.col("_range") / width))
    )
    groups = ranges.groupBy("_group").agg(*[F.sum(c).alias(c) for c in sums])
    groups = groups.select("_group", *before(Window.orderBy(order("_group"))))
    placed = ranges.select("_range", "_group", *before(Window.partitionBy("_group").orderBy(order("_range"))))
    offsets = placed.alias("r").join(groups.alias("g"), "_group").select(
        "_range", *[(F.col(f"r.{c}_before") + F.col(f"g.{c}_before")).alias(f"{c}_before") for c in sums]
    )

    inside = Window.partitionBy("_range").orderBy(order(value))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.select(
        value,
        "_range",
        "row_count",
        F.coalesce(
            F.sum("row_count").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_rows_in"),
        F.row_number().over(inside).cast("bigint").alias("_place_in"),
        *([F.sum("_sum").over(upto).alias("_total_in")] if total else []),
    ).join(offsets, "_range")
    return ranked.select(
        value,
        (F.col("_rows_before") + F.col("_rows_in") + 1).alias("rank_no"),
        (F.col("_values_before") + F.col("_place_in")).alias("dense_rank_no"),
        "row_count",
        *(
            [(F.col("_total_before") + F.col("_total_in")).alias("running_total")]
            if total
            else []
        ),
    )


def quantile_cuts(
    df: DataFrame, value: str, groups: int, *, width: int = RANGE_WIDTH
) -> DataFrame:
    """One row, one array ``cuts``: lowest value of the groups 2 .. ``groups``.

    A value belongs to group ``1 + groups * rows below it div all rows``:
    ``ntile`` with ties kept together. A group no value reaches has NULL.
    """
    ranks = value_ranks(df, value, width=width)
    total = df.agg(F.count(value)).scalar()
    group = F.call_function("div", (F.col("rank_no") - 1) * groups, total) + 1
    return ranks.select(value, group.alias("_group")).agg(
        F.array(
            *[
                F.min(F.when(F.col("_group") >= g, F.col(value)))
                for g in range(2, groups + 1)
            ]
        ).alias("cuts")
    )


def quantile_group(value: Column, cuts: DataFrame, groups: int) -> Column:
    """Group number 1..``groups`` of ``value``, from the one-row ``cuts`` table.

    The cuts are one scalar subquery: the tasks see a literal, not a join.
    """
    lowest = cuts.select("cuts").scalar()
    reached = F.lit(1)
    for i in range(groups - 1):
        above = (value >= lowest.getItem(i)).cast("int")
        reached = reached + F.coalesce(above, F.lit(0))
    return F.when(value.isNotNull(), reached)
