"""Instants, date keys and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.contracts import WEEKEND_DAYS


def instant(value: Column) -> Column:
    """Text or date-time to an instant; unreadable text becomes NULL."""
    return value.try_cast("timestamp_ntz")


def date_key(when: Column) -> Column:
    """Calendar day as the integer ``yyyyMMdd``."""
    return F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)


def whole_years(df: DataFrame, instant_col: str) -> DataFrame:
    """One row: first and last day of the calendar years ``df`` spans."""
    return df.agg(
        F.trunc(F.min(instant_col).cast("date"), "year").alias("first_day"),
        F.make_date(F.year(F.max(instant_col)), F.lit(12), F.lit(31)).alias("last_day"),
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """One row per day, both ends included, from a one-row ``bounds`` table."""
    one_day = F.expr("interval 1 day")
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", one_day)).alias("full_date")
    )


def day_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``full_date``; weeks start on Sunday = 1."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(*WEEKEND_DAYS).alias("is_weekend"),
    )
