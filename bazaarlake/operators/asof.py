"""As-of join: each row with the latest row of a history, by key, at or before its time.

Both sides are merged in one sorted pass per key and period: one shuffle, no range
condition, no pairs. A period is a piece of the time line, so a key with a large share
of all rows is many groups. What a period inherits is the last history row of the
periods before it; that table has a row per key and period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    history: DataFrame,
    by: Sequence[str],
    left_time: str,
    history_time: str,
    values: Sequence[str],
    *,
    period: Column | int = 100,
    strictly: bool = False,
) -> DataFrame:
    """``left`` with ``values`` of ``history``; NULL where nothing is early enough.

    ``period`` is the number of time units in a piece (times are then whole numbers) or
    an expression over the column ``time`` that never falls as time rises. ``strictly``
    leaves out history rows of the same time. Of history rows of one key and time the
    one with the largest values counts. Rows with a NULL key or time match nothing.
    """
    clash = [n for n in (*values, "time", "piece") if n in left.columns]
    if clash:
        raise ValueError(f"left has columns of those names already: {', '.join(clash)}")
    keys = [f"_k{i}" for i in range(len(by))]
    side = F.struct(*[F.col(c) for c in left.columns])
    found = F.struct(*[F.col(v) for v in values])
    piece = F.floor(F.col("time") / period) if isinstance(period, int) else period

    def tagged(df: DataFrame, time: str, **columns: Column) -> DataFrame:
        named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
        return df.select(*named, F.col(time).alias("time"), *[c.alias(n) for n, c in columns.items()])

    no_row = F.lit(None).cast(left.select(side).schema[0].dataType)
    no_value = F.lit(None).cast(history.select(found).schema[0].dataType)
    rows = tagged(left, left_time, row=side, found=no_value, is_row=F.lit(1))
    known = tagged(history, history_time, row=no_row, found=found, is_row=F.lit(0)).dropna(
        subset=[*keys, "time"]
    )
    merged = rows.unionByName(known).withColumn("piece", piece)

    # At one time history comes first, unless it must be earlier; larger values last.
    turn = F.desc("is_row") if strictly else F.asc("is_row")
    order = Window.partitionBy(*keys, "piece").orderBy("time", turn, F.asc_nulls_first("found"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    inside = merged.withColumn("found", F.last("found", ignorenulls=True).over(upto)).filter("is_row = 1")

    ends = known.withColumn("piece", piece).groupBy(*keys, "piece").agg(
        F.max(F.struct("time", "found")).alias("end")
    )
    # A piece that only has rows of the left side inherits too.
    pieces = rows.dropna(subset=[*keys, "time"]).withColumn("piece", piece).select(*keys, "piece").distinct()
    line = ends.unionByName(pieces, allowMissingColumns=True).groupBy(*keys, "piece").agg(
        F.max("end").alias("end")
    )
    earlier = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    inherited = line.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("piece").alias("_piece"),
        F.last("end.found", ignorenulls=True).over(earlier).alias("inherited"),
    ).filter("inherited IS NOT NULL")
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("piece") == F.col("_piece")]
    whole = inside.join(inherited, on, "left")
    matched = F.when(F.col("time").isNotNull(), F.coalesce("found", "inherited"))
    for k in keys:
        matched = F.when(F.col(k).isNotNull(), matched)
    return whole.select("row.*", matched.alias("_match")).select(
        *left.columns, *[F.col("_match")[v].alias(v) for v in values]
    )
