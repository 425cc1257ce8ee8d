"""Distinct counts and percentiles of any period, from small stored states per day.

A state is a sketch: of a day's customers (theta), of a day's delivery times (KLL).
Sketches of days unite to those of months, years or anything else, so a new day is
added without reading the days before it. Theta sketches also intersect and subtract,
which gives returning and new customers.

A theta sketch of ``2 ** log_k`` entries counts exactly up to that many distinct
values; beyond them its standard error is ``1 / sqrt(2 ** log_k)``, 0.8 % for 14.
Uniting is idempotent: rows added twice count once. A KLL sketch counts rows, so
a change set replaces its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.percentiles import (
    RANK_ERROR,
    exact_percentiles,
    merged,
    sketch_of,
    sketched_percentiles,
)
from bazaarlake.sources.layers import Lake

LOG_K = 14
DAY = "purchase_date_key"


def add_states(lake: Lake, name: str, states: DataFrame, change_set: str) -> None:
    """Store states as one partition; a repeated change set replaces its own."""
    lake.write(
        states.withColumn("change_set", F.lit(change_set)),
        "gold",
        f"sketch_{name}",
        partition_by=["change_set"],
        dynamic=True,
    )


def states(lake: Lake, name: str) -> DataFrame:
    return lake.read("gold", f"sketch_{name}")


# ---- customers ----


def daily_customers(fact_sales: DataFrame, customer: str = "customer_id", log_k: int = LOG_K) -> DataFrame:
    """One sketch of the customers of each day; lines without a day have none."""
    return (
        fact_sales.filter(F.col(DAY).isNotNull())
        .groupBy(DAY)
        .agg(F.theta_sketch_agg(customer, log_k).alias("customers"))
    )


def _with_period(states: DataFrame) -> DataFrame:
    year, month = F.call_function("div", F.col(DAY), F.lit(10000)), F.call_function("div", F.col(DAY), F.lit(100)) % 100
    return states.select(
        "*",
        year.cast("int").alias("year"),
        F.call_function("div", month + 2, F.lit(3)).cast("int").alias("quarter"),
        month.cast("int").alias("month"),
    )


def distinct_by_period(states: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """Distinct customers by month, quarter, year and in all."""
    grouping = F.grouping_id()
    level = F.when(grouping == 0, "month").when(grouping == 1, "quarter").when(grouping == 3, "year")
    return (
        _with_period(states)
        .rollup("year", "quarter", "month")
        .agg(
            level.otherwise("all").alias("level"),
            F.theta_sketch_estimate(F.theta_union_agg("customers", log_k)).alias("customers"),
        )
        .select("level", "year", "quarter", "month", "customers")
    )


def flow_by_month(states: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """Customers of each month: all, those of the month before too, those never seen before.

    The windows have one row per month.
    """
    monthly = _with_period(states).groupBy("year", "month").agg(
        F.theta_union_agg("customers", log_k).alias("now")
    )
    order = Window.orderBy("year", "month")
    number = F.col("year") * 12 + F.col("month")
    seen = monthly.select(
        "*",
        F.lag("now").over(order).alias("last"),
        (number - F.lag(number).over(order)).alias("gap"),
        F.theta_union_agg("now", log_k)
        .over(order.rowsBetween(Window.unboundedPreceding, -1))
        .alias("earlier"),
    )
    count = F.theta_sketch_estimate
    now = F.col("now")
    return seen.select(
        "year",
        "month",
        count(now).alias("customers"),
        F.when(F.col("gap") == 1, count(F.theta_intersection(now, F.col("last"))))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("returning_customers"),
        F.when(F.col("last").isNull(), count(now))
        .otherwise(count(F.theta_difference(now, F.col("earlier"))))
        .alias("new_customers"),
    )


# ---- delivery times ----


def delivered_by_state(fulfillment: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """``customer_state``, day and shipping days of delivered orders."""
    arrived = fulfillment.filter(F.col("shipping_duration_days").isNotNull())
    place = dim_customers.select("customer_id", "customer_state")
    return arrived.join(place, "customer_id").select("customer_state", DAY, "shipping_duration_days")


def delivery_percentiles(
    delivered: DataFrame, by: Sequence[str] = ("customer_state",), shares: Sequence[int] = (50, 90, 99)
) -> DataFrame:
    """Exact percentiles of shipping days."""
    return exact_percentiles(delivered, by, "shipping_duration_days", shares).withColumnRenamed(
        "values_n", "deliveries"
    )


def daily_delivery(delivered: DataFrame, by: Sequence[str] = ("customer_state",)) -> DataFrame:
    """A sketch of the shipping days of each group and day."""
    return delivered.groupBy(*by, DAY).agg(
        F.count("*").alias("deliveries"), sketch_of("shipping_duration_days").alias("shipping_days")
    )


def sketched_delivery(
    states: DataFrame, by: Sequence[str] = ("customer_state",), shares: Sequence[int] = (50, 90, 99)
) -> DataFrame:
    """Percentiles from the sketches of any days, each within RANK_ERROR of its rank."""
    whole = states.groupBy(*by).agg(
        F.sum("deliveries").alias("deliveries"), merged("shipping_days").alias("shipping_days")
    )
    return whole.select(*by, "deliveries", *sketched_percentiles("shipping_days", shares))


def rank_errors(
    delivered: DataFrame, sketched: DataFrame, by: str = "customer_state", shares: Sequence[int] = (50, 90, 99)
) -> DataFrame:
    """Whether each sketched percentile keeps its promise.

    ``p50_holds`` and so on: some rank of the value is within RANK_ERROR of the share.
    """
    days = F.col("shipping_duration_days")
    met = delivered.join(sketched.withColumnRenamed(by, "_by"), F.col(by) == F.col("_by"))
    counted = met.groupBy(by).agg(
        F.count("*").alias("deliveries"),
        *[
            F.struct(F.count_if(days < F.col(f"p{s}")).alias("below"), F.count_if(days <= F.col(f"p{s}")).alias("upto")).alias(f"r{s}")
            for s in shares
        ],
    )
    n = F.col("deliveries")
    return counted.select(
        by,
        "deliveries",
        *[
            ((F.col(f"r{s}.below") <= n * (s / 100 + RANK_ERROR)) & (F.col(f"r{s}.upto") >= n * (s / 100 - RANK_ERROR))).alias(f"p{s}_holds")
            for s in shares
        ],
    )
