"""Star schema to the four marts.

Marts come unsorted: the order of rows in files is no contract, and a global
sort of a large mart before writing it would be a wasted shuffle. Reports
sort what they show.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.contracts import PLATINUM, POSITIVE_SCORE
from bazaarlake.functions.growth import period_growth
from bazaarlake.functions.money import (
    amount,
    cents,
    mean_amount,
    mean_int,
    mean_money,
    percent,
    sum_cents,
    sum_money,
)
from bazaarlake.lazy import Plans
from bazaarlake.operators.schema import conform


def _sales_measures() -> dict[str, F.Column]:
    """Aggregates of ``fact_sales`` that more than one mart needs."""
    revenue = sum_cents(F.col("total_item_value"))
    orders = F.count_distinct("order_id")
    return {
        "revenue": amount(revenue),
        "orders": orders,
        "items": F.count("order_item_id"),
        "avg_order_value": mean_amount(revenue, orders),
        "avg_price": mean_money(F.col("price")),
        "freight": sum_money(F.col("freight_value")),
    }


def sales_summary_mart(
    fact_sales: DataFrame,
    dim_date: DataFrame,
    *,
    densify: bool = False,
    payments_once: bool = False,
) -> DataFrame:
    """Sales per calendar day, with growth against the previous present day.

    Days outside the calendar are dropped. With ``densify`` growth is against
    the day before, and NULL if that day had no sales. ``total_payment`` adds
    the order's payment once per line, as the fact holds it; with
    ``payments_once`` a column ``total_payment_orders`` counts each order once.
    """
    m = _sales_measures()
    daily = fact_sales.groupBy("purchase_date_key").agg(
        m["revenue"].alias("total_revenue"),
        sum_money(F.col("total_payment_value")).alias("total_payment"),
        m["orders"].alias("total_orders"),
        m["items"].alias("total_items"),
        m["avg_order_value"].alias("avg_order_value"),
        m["avg_price"].alias("avg_item_price"),
        m["freight"].alias("total_freight"),
    )
    mart = with_calendar(daily, dim_date, densify=densify)
    if payments_once:
        once = (
            fact_sales.groupBy("purchase_date_key", "order_id")
            .agg(F.max(cents(F.col("total_payment_value"))).alias("paid"))
            .groupBy("purchase_date_key")
            .agg(amount(F.sum("paid")).alias("total_payment_orders"))
        )
        mart = mart.join(once, "purchase_date_key", "left")
    return mart


def with_calendar(
    daily: DataFrame, dim_date: DataFrame, *, densify: bool = False
) -> DataFrame:
    """The daily mart from figures per ``purchase_date_key``."""
    days = dim_date.withColumnRenamed("date_key", "purchase_date_key")
    dated = daily.join(days, "purchase_date_key", "right" if densify else "inner")
    # At most one row per calendar day from here on.
    grown = period_growth(
        dated, "total_revenue", "purchase_date_key", output="revenue_day_growth_pct"
    )
    return conform(
        grown.filter("total_orders IS NOT NULL"), PLATINUM["sales_summary_mart"]
    )


def customer_mart(
    fact_sales: DataFrame, dim_customers: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per customer id with at least one order line."""
    m = _sales_measures()
    per_customer = fact_sales.groupBy("customer_id").agg(
        m["orders"].alias("total_orders"),
        m["revenue"].alias("total_spent"),
        m["avg_order_value"].alias("avg_order_value"),
        m["items"].alias("total_items_purchased"),
        m["freight"].alias("total_freight_paid"),
        m["avg_price"].alias("avg_item_price"),
        F.max("purchase_date_key").alias("last_purchase_date_key"),
    )
    return with_customer(per_customer, dim_customers, dim_date)


def with_customer(
    per_customer: DataFrame, dim_customers: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """The customer mart from figures per ``customer_id``."""
    days = dim_date.select(
        F.col("date_key").alias("last_purchase_date_key"),
        F.col("full_date").alias("last_purchase_date"),
    )
    return conform(
        per_customer.withColumn(
            "is_repeat_customer", F.when(F.col("total_orders") > 1, 1).otherwise(0)
        )
        .join(dim_customers, "customer_id")
        .join(days, "last_purchase_date_key", "left"),
        PLATINUM["customer_mart"],
    )


def product_mart(fact_sales: DataFrame, dim_products: DataFrame) -> DataFrame:
    """One row per product with at least one order line."""
    m = _sales_measures()
    per_product = fact_sales.groupBy("product_id").agg(
        m["revenue"].alias("total_sales"),
        m["items"].alias("total_quantity"),
        m["orders"].alias("total_orders"),
        m["avg_price"].alias("avg_price"),
        mean_money(F.col("freight_value")).alias("avg_freight"),
        m["freight"].alias("total_freight"),
    )
    return with_product(per_product, dim_products)


def with_product(per_product: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The product mart from figures per ``product_id``."""
    return conform(
        per_product.join(dim_products, "product_id").withColumnRenamed(
            "product_category_en", "category"
        ),
        PLATINUM["product_mart"],
    )


def _distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def _one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side, without a cross join.

    Each part is a global aggregate; the union has one row per part, and
    ``max`` picks the only value every column has.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), parts
    )
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


# What the KPI row reads of the sales fact.
KPI_SALES_COLUMNS = (
    "order_id",
    "order_item_id",
    "customer_id",
    "seller_id",
    "product_id",
    "total_item_value",
)


def with_person(fact_sales: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Sales lines with the person behind the customer id.

    Lines whose customer is not in the dimension stay, without a person. Where
    every order gets a customer id of its own, only the person shows who
    bought again: ``kpi_summary(..., customer_key="customer_unique_id")``.
    """
    people = dim_customers.select("customer_id", "customer_unique_id")
    return fact_sales.join(people, "customer_id", "left")


def kpi_summary(
    fact_sales: DataFrame,
    fact_fulfillment: DataFrame,
    *,
    customer_key: str = "customer_id",
) -> DataFrame:
    """One row of headline figures.

    Delivery figures look at delivered orders, review figures at scored rows;
    a row counts once per review of its order. Customers and repeat customers
    are told apart by ``customer_key``. The sales fact is read once per distinct
    count, a column or two each time: pass a written table, not a plan of joins.
    """
    # (customer, order) first: it serves revenue, items, customers and repeat
    # customers, and the shuffle carries one row per order and map task.
    per_customer = (
        fact_sales.groupBy(customer_key, "order_id")
        .agg(
            sum_cents(F.col("total_item_value")).alias("spent"),
            F.count("order_item_id").alias("items"),
        )
        .groupBy(customer_key)
        .agg(
            F.sum("spent").alias("spent"),
            F.sum("items").alias("items"),
            F.count("order_id").alias("orders"),
        )
    )
    sales = per_customer.agg(
        # Wider than bigint: the total of all orders in cents.
        F.sum(F.col("spent").cast("decimal(28,0)")).alias("revenue"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"),
        F.count(customer_key).alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customer_count"),
    )
    days, delay = F.col("shipping_duration_days"), F.col("delivery_delay_days")
    score = F.col("review_score")
    arrived = days.isNotNull()
    quality = fact_fulfillment.agg(
        mean_int(days).alias("avg_delivery_time_days"),
        mean_int(F.when(arrived, delay)).alias("avg_delivery_delay_days"),
        percent(
            F.sum(F.when(arrived, F.col("is_late_delivery"))), F.count_if(arrived)
        ).alias("late_delivery_rate_pct"),
        mean_int(score).alias("avg_review_score"),
        percent(F.count_if(score >= POSITIVE_SCORE), F.count(score)).alias(
            "positive_review_rate_pct"
        ),
        F.count(score).alias("total_reviews"),
    )
    return headline(
        sales,
        quality,
        _distinct_count(fact_sales, "order_id", "total_orders"),
        _distinct_count(fact_sales, "seller_id", "total_sellers"),
        _distinct_count(fact_sales, "product_id", "total_products"),
    )


def headline(*parts: DataFrame) -> DataFrame:
    """The KPI row from one-row tables with its sums, counts and rates."""
    figures = _one_row(*parts)
    revenue, customers = F.col("revenue"), F.col("total_customers")
    return conform(
        figures.select(
            "*",
            amount(revenue).alias("total_revenue"),
            mean_amount(revenue, F.col("total_orders")).alias("avg_order_value"),
            mean_amount(revenue, customers).alias("revenue_per_customer"),
            F.round(100 - F.col("late_delivery_rate_pct"), 2).alias(
                "on_time_delivery_rate_pct"
            ),
            percent(F.col("repeat_customer_count"), customers).alias(
                "repeat_customer_rate_pct"
            ),
        ),
        PLATINUM["kpi_summary"],
    )


def all_marts(star: Mapping[str, DataFrame]) -> Plans:
    """All four marts from the star schema."""
    return Plans(
        {
            "sales_summary_mart": lambda: sales_summary_mart(
                star["fact_sales"], star["dim_date"]
            ),
            "customer_mart": lambda: customer_mart(
                star["fact_sales"], star["dim_customers"], star["dim_date"]
            ),
            "product_mart": lambda: product_mart(
                star["fact_sales"], star["dim_products"]
            ),
            "kpi_summary": lambda: kpi_summary(
                star["fact_sales"], star["fact_order_fulfillment"]
            ),
        }
    )
