"""Data-quality checks. Each returns rows; none prints or decides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.contracts import ZIP_WIDTH


def _long_form(totals: DataFrame, rows: Sequence[Sequence[Column]], names) -> DataFrame:
    """Turn a one-row table of aggregates into one row per item."""
    structs = [
        F.struct(*[value.alias(name) for value, name in zip(row, names, strict=True)])
        for row in rows
    ]
    return totals.select(F.inline(F.array(*structs)))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, non-NULL and NULL count of every column, in one pass."""
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(n)).alias(n) for n in df.columns]
    )
    return _long_form(
        totals,
        [
            (
                F.lit(name),
                F.lit(dtype),
                F.col(name),
                F.col("_rows") - F.col(name),
                F.col("_rows"),
            )
            for name, dtype in df.dtypes
        ],
        ("column_name", "data_type", "non_null", "nulls", "row_count"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row: NULLs per column, under the column's own name."""
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in df.columns])


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values below zero per numeric column, in one pass."""
    totals = df.agg(*[F.count_if(F.col(n) < 0).alias(n) for n in columns])
    return _long_form(
        totals, [(F.lit(n), F.col(n)) for n in columns], ("column_name", "negatives")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")
    )


def orphan_rows(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose key has no parent row (a NULL key has none)."""
    known = parent.select(F.col(parent_key or child_key).alias("_parent_key"))
    return child.join(known, F.col(child_key) == F.col("_parent_key"), "left_anti")


def temporal_violations(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where the ``earlier`` day falls after the ``later`` day."""
    return df.filter(F.to_date(earlier) > F.to_date(later))


def value_frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct value."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text matches a LIKE pattern."""
    return df.filter(F.col(column).like(pattern))


def zip_ranges(df: DataFrame, zip_col: str) -> DataFrame:
    """Row counts by shape of a raw zip: leading zero, wrong length, other.

    Zips are compared as text, so any prefix that sorts after all digits is
    reported as out of range.
    """
    code = F.col(zip_col)
    shape = (
        F.when(code.isNull(), "missing")
        .when(F.length(code) != ZIP_WIDTH, "wrong length")
        .when(code < "10000", "leading zero")
        .when(code > "99999", "out of range")
        .otherwise("plain")
    )
    return df.groupBy(shape.alias("zip_shape")).agg(F.count("*").alias("row_count"))


def payment_mismatches(fact_sales: DataFrame) -> DataFrame:
    """Sales lines whose item value differs from the order's payment."""
    return fact_sales.filter(F.col("total_item_value") != F.col("total_payment_value"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name and row count."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def validate_counts(counts: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Add PASS / FAIL against ``expected`` (table_name, expected_count).

    A table without an expectation is EXISTS; an expected table that was not
    counted is MISSING.
    """
    if expected is None:
        return counts.select(
            "table_name",
            F.lit(None).cast("bigint").alias("expected_count"),
            "row_count",
            F.lit("EXISTS").alias("status"),
        )
    status = (
        F.when(F.col("row_count").isNull(), "MISSING")
        .when(F.col("expected_count").isNull(), "EXISTS")
        .when(F.col("row_count") == F.col("expected_count"), "PASS")
        .otherwise("FAIL")
    )
    return counts.join(expected, "table_name", "full_outer").select(
        "table_name", "expected_count", "row_count", status.alias("status")
    )
