"""Column profiles as states that add up.

A state has one row per column: rows, NULLs, smallest and largest text or number, a
theta sketch of the distinct values, a KLL sketch of the numbers and a bounded counter
of the frequent values. States of two lots of rows merge into the state of both, so new
rows are profiled alone.

Distinct counts are exact up to ``2 ** LOG_K`` values; frequent values are counted
exactly while a column has at most three quarters of ``TRACKED`` distinct ones, and
beyond that a value held by more than 1 in ``TRACKED`` / 4 rows is never missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_K = 14
SKETCH_K = 200
TRACKED = 1024

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def profile_state(df: DataFrame) -> DataFrame:
    """The state of ``df``'s rows, in one pass: every row is folded within its task first."""
    values = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"`{name}`").cast("string").alias("value"),
            (F.col(f"`{name}`").cast("double") if kind.startswith(_NUMBERS) else F.lit(None).cast("double")).alias("number"),
        )
        for name, kind in df.dtypes
    ]
    long = df.select(F.inline(F.array(*values)))
    return long.groupBy("column_name", "data_type").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.min("value").alias("least_text"),
        F.max("value").alias("largest_text"),
        F.min("number").alias("least_number"),
        F.max("number").alias("largest_number"),
        F.theta_sketch_agg("value", LOG_K).alias("distinct"),
        F.kll_sketch_agg_double("number", SKETCH_K).alias("quantiles"),
        F.call_function("approx_top_k_accumulate", F.col("value"), F.lit(TRACKED)).alias("frequent"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state of any number of them."""
    return states.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("nulls").alias("nulls"),
        F.min("least_text").alias("least_text"),
        F.max("largest_text").alias("largest_text"),
        F.min("least_number").alias("least_number"),
        F.max("largest_number").alias("largest_number"),
        F.theta_union_agg("distinct", LOG_K).alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    )


def profile(state: DataFrame) -> DataFrame:
    """A state's figures: ``median`` of numbers only, ``top`` value and its rows."""
    # A NULL is counted as a value by the counter.
    listed = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(TRACKED))
    frequent = F.filter(listed, lambda f: f["item"].isNotNull())
    first = F.array_sort(
        frequent,
        lambda a, b: F.when(a["count"] != b["count"], F.when(a["count"] > b["count"], -1).otherwise(1))
        .when(a["item"] < b["item"], -1)
        .otherwise(F.when(a["item"] > b["item"], 1).otherwise(0)),
    )
    number = F.col("largest_number").isNotNull()
    least, largest = (
        F.when(number, F.col(f"{side}_number").cast("string")).otherwise(F.col(f"{side}_text"))
        for side in ("least", "largest")
    )
    return state.select(
        "column_name",
        "data_type",
        "row_count",
        "nulls",
        F.theta_sketch_estimate("distinct").alias("distinct_values"),
        least.alias("least"),
        largest.alias("largest"),
        F.when(number, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median"),
        F.get(first, F.lit(0))["item"].alias("top"),
        F.get(first, F.lit(0))["count"].alias("top_rows"),
    )
