"""Reports over the marts.

Each takes a mart and returns a sorted DataFrame. NULLs sort last, and every
top list has a tie-break so that its rows are determined. ``orderBy`` with
``limit`` plans as a top-k per task, never as a full sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import contracts as c
from bazaarlake.functions.money import (
    mean_amount,
    mean_int,
    mean_money,
    percent,
    sum_cents,
    sum_money,
)
from bazaarlake.functions.tiers import tier
from bazaarlake.operators.quality import row_counts


def _top(df: DataFrame, metric: str, k: int, *ties: str, lowest=False) -> DataFrame:
    first = F.asc_nulls_last(metric) if lowest else F.desc_nulls_last(metric)
    return df.orderBy(first, *[F.asc_nulls_last(t) for t in ties]).limit(k)


def _desc(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric), *[F.asc_nulls_last(t) for t in ties])


def _n() -> Column:
    return F.count("*")


# ---- all marts ----


def mart_row_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(marts)


def preview(mart: DataFrame, keys: tuple[str, ...] = (), rows: int = 10) -> DataFrame:
    """First rows of a mart, by key where one is given."""
    ordered = mart.orderBy(*[F.asc_nulls_last(k) for k in keys]) if keys else mart
    return ordered.limit(rows)


def headline_kpis(kpi: DataFrame) -> DataFrame:
    return kpi.select(*c.PLATINUM["kpi_summary"].columns)


# ---- sales by day ----


def daily_trend(sales: DataFrame, rows: int = 30) -> DataFrame:
    """The most recent days that had sales."""
    return (
        sales.select(
            "purchase_date_key",
            "full_date",
            "day_name",
            "is_weekend",
            "total_revenue",
            "total_payment",
            "total_orders",
            "total_items",
            "avg_order_value",
            "avg_item_price",
            "total_freight",
            "revenue_day_growth_pct",
        )
        .orderBy(F.desc_nulls_last("purchase_date_key"))
        .limit(rows)
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    revenue = F.col("total_revenue")
    return (
        sales.groupBy("year", "month")
        .agg(
            sum_money(revenue).alias("monthly_revenue"),
            sum_money(F.col("total_payment")).alias("monthly_payment"),
            F.sum("total_orders").alias("monthly_orders"),
            F.sum("total_items").alias("monthly_items"),
            sum_money(F.col("total_freight")).alias("monthly_freight"),
            mean_amount(sum_cents(revenue), F.sum("total_orders")).alias(
                "avg_order_value"
            ),
        )
        .orderBy("year", "month")
    )


def quarterly_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("year", "quarter")
        .agg(
            sum_money(F.col("total_revenue")).alias("quarterly_revenue"),
            F.sum("total_orders").alias("quarterly_orders"),
            F.sum("total_items").alias("quarterly_items"),
        )
        .orderBy("year", "quarter")
    )


def weekend_vs_weekday(sales: DataFrame) -> DataFrame:
    """Two rows. Grouped by the label, so an unset flag counts as weekday."""
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return (
        sales.groupBy(day_type.alias("day_type"))
        .agg(
            _n().alias("num_days"),
            sum_money(F.col("total_revenue")).alias("total_revenue"),
            mean_money(F.col("total_revenue")).alias("avg_daily_revenue"),
            F.sum("total_orders").alias("total_orders"),
            mean_int(F.col("total_orders")).alias("avg_daily_orders"),
            mean_money(F.col("avg_item_price")).alias("avg_item_price"),
        )
        .orderBy("day_type")
    )


def revenue_by_weekday(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("day_name", "day_of_week")
        .agg(
            sum_money(F.col("total_revenue")).alias("total_revenue"),
            mean_money(F.col("total_revenue")).alias("avg_daily_revenue"),
            F.sum("total_orders").alias("total_orders"),
        )
        .orderBy(F.asc_nulls_last("day_of_week"))
    )


def top_revenue_days(sales: DataFrame, k: int = 10) -> DataFrame:
    shown = sales.select(
        "purchase_date_key",
        "full_date",
        "day_name",
        "total_revenue",
        "total_orders",
        "avg_order_value",
    )
    return _top(shown, "total_revenue", k, "purchase_date_key")


def top_growth_days(sales: DataFrame, k: int = 10) -> DataFrame:
    shown = sales.filter(F.col("revenue_day_growth_pct").isNotNull()).select(
        "purchase_date_key", "full_date", "total_revenue", "revenue_day_growth_pct"
    )
    return _top(shown, "revenue_day_growth_pct", k, "purchase_date_key")


# ---- customers ----


def top_customers(customers: DataFrame, k: int = 20) -> DataFrame:
    shown = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "total_orders",
        "total_spent",
        "avg_order_value",
        "total_items_purchased",
        "total_freight_paid",
        "avg_item_price",
        "last_purchase_date",
        "is_repeat_customer",
    )
    return _top(shown, "total_spent", k, "customer_id")


def customers_by_state(customers: DataFrame) -> DataFrame:
    repeat = F.count_if(F.col("is_repeat_customer") == 1)
    by_state = customers.groupBy("customer_state").agg(
        _n().alias("customer_count"),
        sum_money(F.col("total_spent")).alias("total_revenue"),
        mean_money(F.col("total_spent")).alias("avg_customer_value"),
        F.sum("total_orders").alias("total_orders"),
        repeat.alias("repeat_customers"),
        percent(repeat, _n()).alias("repeat_rate_pct"),
    )
    return _desc(by_state, "total_revenue", "customer_state")


def repeat_vs_one_time(customers: DataFrame) -> DataFrame:
    kind = F.when(F.col("is_repeat_customer") == 1, "Repeat").otherwise("One-time")
    return (
        customers.groupBy(kind.alias("customer_type"))
        .agg(
            _n().alias("customer_count"),
            sum_money(F.col("total_spent")).alias("total_revenue"),
            mean_money(F.col("total_spent")).alias("avg_spending"),
            mean_int(F.col("total_orders")).alias("avg_orders"),
            mean_money(F.col("avg_item_price")).alias("avg_item_price"),
        )
        .orderBy("customer_type")
    )


def spending_tiers(customers: DataFrame) -> DataFrame:
    label = tier(F.col("total_spent"), c.SPENDING_TIERS, c.SPENDING_TIER_REST)
    by_tier = customers.groupBy(label.alias("spending_tier")).agg(
        _n().alias("customer_count"),
        sum_money(F.col("total_spent")).alias("total_revenue"),
        mean_int(F.col("total_orders")).alias("avg_orders"),
        mean_int(F.col("total_items_purchased")).alias("avg_items"),
    )
    return _desc(by_tier, "total_revenue", "spending_tier")


def top_cities(customers: DataFrame, k: int = 10) -> DataFrame:
    by_city = customers.groupBy("customer_city", "customer_state").agg(
        _n().alias("customer_count"),
        sum_money(F.col("total_spent")).alias("total_revenue"),
        mean_money(F.col("total_spent")).alias("avg_customer_value"),
    )
    return _top(by_city, "total_revenue", k, "customer_city", "customer_state")


def top_states(customers: DataFrame, k: int = 10) -> DataFrame:
    by_state = customers.groupBy("customer_state").agg(
        _n().alias("customer_count"),
        sum_money(F.col("total_spent")).alias("total_customer_revenue"),
        mean_money(F.col("total_spent")).alias("avg_customer_value"),
        F.sum("total_orders").alias("total_orders"),
    )
    return _top(by_state, "total_customer_revenue", k, "customer_state")


# ---- products ----


def top_products(products: DataFrame, k: int = 20) -> DataFrame:
    shown = products.select(
        "product_id",
        "category",
        "total_sales",
        "total_quantity",
        "total_orders",
        "avg_price",
        "avg_freight",
        "total_freight",
    )
    return _top(shown, "total_sales", k, "product_id")


def sales_by_category(products: DataFrame) -> DataFrame:
    """Products without a category form a group of their own."""
    by_category = products.groupBy("category").agg(
        _n().alias("product_count"),
        sum_money(F.col("total_sales")).alias("total_revenue"),
        F.sum("total_quantity").alias("total_items"),
        F.sum("total_orders").alias("total_orders"),
        mean_money(F.col("avg_price")).alias("avg_price"),
        mean_money(F.col("avg_freight")).alias("avg_freight"),
        sum_money(F.col("total_freight")).alias("total_freight"),
    )
    return _desc(by_category, "total_revenue", "category")


def top_categories(products: DataFrame, k: int = 10) -> DataFrame:
    by_category = products.groupBy("category").agg(
        sum_money(F.col("total_sales")).alias("total_revenue"),
        F.sum("total_quantity").alias("total_items"),
        _n().alias("product_count"),
    )
    return _top(by_category, "total_revenue", k, "category")


def weight_vs_freight(products: DataFrame) -> DataFrame:
    """Products of known weight, by weight tier."""
    weight = F.col("product_weight_g")
    label = tier(weight, c.WEIGHT_TIERS, c.WEIGHT_TIER_REST)
    by_tier = (
        products.filter(weight.isNotNull())
        .groupBy(label.alias("weight_tier"))
        .agg(
            _n().alias("product_count"),
            mean_money(F.col("avg_freight")).alias("avg_freight"),
            mean_money(F.col("avg_price")).alias("avg_price"),
            sum_money(F.col("total_sales")).alias("total_revenue"),
            sum_money(F.col("total_freight")).alias("total_freight"),
        )
    )
    return _desc(by_tier, "avg_freight", "weight_tier")


def product_volumes(products: DataFrame, k: int = 20) -> DataFrame:
    """Volume of the best-selling products of known size."""
    sides = [
        F.col(f"product_{side}_cm") for side in ("length", "height", "width")
    ]
    length, height, width = sides
    shown = products.filter(
        length.isNotNull() & height.isNotNull() & width.isNotNull()
    ).select(
        "product_id",
        "category",
        "total_sales",
        "avg_price",
        "product_weight_g",
        F.round(length * height * width, 2).alias("volume_cm3"),
        "avg_freight",
    )
    return _top(shown, "total_sales", k, "product_id")


def category_performance(products: DataFrame, k: int = 15) -> DataFrame:
    by_category = products.groupBy("category").agg(
        _n().alias("product_count"),
        sum_money(F.col("total_sales")).alias("category_revenue"),
        F.sum("total_quantity").alias("total_items_sold"),
        mean_money(F.col("avg_price")).alias("avg_product_price"),
        F.round(F.avg("product_weight_g"), 2).alias("avg_weight_g"),
        sum_money(F.col("total_freight")).alias("total_freight_cost"),
    )
    return _top(by_category, "category_revenue", k, "category")
