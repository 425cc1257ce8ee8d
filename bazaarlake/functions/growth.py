"""Change against the previous period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.money import cents, ratio


def period_growth(
    df: DataFrame,
    value: str,
    order: str,
    partition: Sequence[str] = (),
    output: str = "growth_pct",
) -> DataFrame:
    """Add the % change of a money column against the previous *present* row.

    NULL for the first row and where the previous value is NULL or 0. ``df``
    is one row per period: without ``partition`` the window is a single task,
    so aggregate to a calendar-bounded number of periods first.
    """
    previous = F.lag(cents(F.col(value))).over(
        Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())
    )
    now, prev = cents(F.col(value)), F.col("_previous")
    # ``ratio`` wants a positive divisor; a negative base flips both signs.
    gain = (now - prev) * F.signum(prev.cast("double")).cast("bigint") * 100
    return (
        df.withColumn("_previous", previous)
        .withColumn(output, ratio(gain, F.abs(prev), 2))
        .drop("_previous")
    )
