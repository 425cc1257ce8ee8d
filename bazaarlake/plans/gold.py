"""Clean tables to star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.contracts import GOLD
from bazaarlake.functions.dates import (
    calendar_days,
    date_key,
    day_attributes,
    days_between,
    whole_years,
)
from bazaarlake.functions.money import round2
from bazaarlake.lazy import Plans
from bazaarlake.operators.schema import conform

# Coordinates as decimals with 14 places: sums do not depend on their order.
_COORDINATE = "decimal(18,14)"


def _mean_coordinate(column: str):
    exact = F.col(column).try_cast(_COORDINATE)
    return (F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))).alias(column)


def _key_apart(column: str) -> Column:
    """A key column as an expression of its own.

    AQE splits a hot key only where both sides of a join come straight from a
    shuffle. A side that was aggregated on the key would be joined without one;
    with this key it is shuffled again, by then at one row per key.
    """
    return F.concat(F.col(column), F.lit(""))


def geo_centroid(points: DataFrame) -> DataFrame:
    """Mean latitude and longitude per zip."""
    return points.groupBy("geolocation_zip_code_prefix").agg(
        _mean_coordinate("geolocation_lat"), _mean_coordinate("geolocation_lng")
    )


def _located(people: DataFrame, points: DataFrame, role: str) -> DataFrame:
    """``people`` with the centroid of their zip, NULL where unknown.

    A zip with a large share of the people is split by AQE.
    """
    where = geo_centroid(points).select(
        _key_apart("geolocation_zip_code_prefix").alias(f"{role}_zip_code_prefix"),
        F.col("geolocation_lat").alias(f"{role}_lat"),
        F.col("geolocation_lng").alias(f"{role}_lng"),
    )
    return people.join(where, f"{role}_zip_code_prefix", "left")


def dim_customers(customers: DataFrame, points: DataFrame) -> DataFrame:
    located = _located(customers, points, "customer")
    return conform(located, GOLD["dim_customers"])


def dim_sellers(sellers: DataFrame, points: DataFrame) -> DataFrame:
    located = _located(sellers, points, "seller")
    return conform(located, GOLD["dim_sellers"])


def dim_products(
    products: DataFrame, translation: DataFrame, *, unknown_label: str | None = None
) -> DataFrame:
    """Products with both category names.

    The English name is looked up afresh, so a category without translation
    is NULL here although the clean table says 'unknown'; ``unknown_label``
    fills it.
    """
    named = products.drop("product_category_name_english").join(
        translation, "product_category_name", "left"
    )
    if unknown_label is not None:
        named = named.fillna({"product_category_name_english": unknown_label})
    renamed = named.withColumnsRenamed(
        {
            "product_category_name": "product_category_pt",
            "product_category_name_english": "product_category_en",
        }
    )
    return conform(renamed, GOLD["dim_products"])


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar between the ``first_day`` and ``last_day`` of a one-row table."""
    return conform(day_attributes(calendar_days(bounds)), GOLD["dim_date"])


def dim_date_of(orders: DataFrame) -> DataFrame:
    """Calendar of the whole years in which orders were placed."""
    return dim_date(whole_years(orders, "order_purchase_timestamp"))


def order_payment_totals(payments: DataFrame) -> DataFrame:
    """Payments per order, summed before any join so that no line repeats them."""
    return payments.groupBy("order_id").agg(
        round2(F.sum("payment_value")).alias("total_payment_value")
    )


def fact_sales(items: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order line.

    Orders and payment totals meet first, at one row per order. The lines are
    shuffled once and join that row; AQE splits an order with a large share of them.
    """
    totals = order_payment_totals(payments)
    head = orders.join(totals, "order_id", "left").select(
        _key_apart("order_id").alias("order_id"),
        "customer_id",
        "order_status",
        date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key"),
        "total_payment_value",
    )
    lines = items.join(head, "order_id")
    price, freight = F.col("price"), F.col("freight_value")
    return lines.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "order_status",
        "purchase_date_key",
        round2(price).alias("price"),
        round2(freight).alias("freight_value"),
        round2(price + freight).alias("total_item_value"),
        "total_payment_value",
    )


def fact_order_fulfillment(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order and review; an order without review has one row.

    Written as reviewed plus unreviewed orders. A left join could not split an
    order that holds a large share of the *reviews* (the right side); the
    inner join can, and the anti join sees each reviewed order once.
    """
    purchased = F.col("order_purchase_timestamp")
    estimated = F.col("order_estimated_delivery_date")
    delivered = F.col("order_delivered_customer_date")
    delay = days_between(delivered, estimated)
    progress = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        date_key(purchased).alias("purchase_date_key"),
        date_key(estimated).alias("estimated_delivery_date_key"),
        date_key(delivered).alias("actual_delivery_date_key"),
        delay.alias("delivery_delay_days"),
        days_between(delivered, purchased).alias("shipping_duration_days"),
        F.when(delay > 0, 1).otherwise(0).alias("is_late_delivery"),
    )
    scores = reviews.select("order_id", "review_id", "review_score")
    reviewed = progress.join(scores, "order_id")
    unreviewed = progress.join(
        scores.select("order_id").distinct(), "order_id", "left_anti"
    ).withColumns(
        {
            "review_id": F.lit(None).cast("string"),
            "review_score": F.lit(None).cast("int"),
        }
    )
    return conform(reviewed.unionByName(unreviewed), GOLD["fact_order_fulfillment"])


def star_schema(clean: Mapping[str, DataFrame]) -> Plans:
    """All six star-schema tables from the clean tables."""
    return Plans(
        {
            "dim_products": lambda: dim_products(
                clean["products"], clean["category_translation"]
            ),
            "dim_sellers": lambda: dim_sellers(clean["sellers"], clean["geolocation"]),
            "dim_customers": lambda: dim_customers(
                clean["customers"], clean["geolocation"]
            ),
            "dim_date": lambda: dim_date_of(clean["orders"]),
            "fact_sales": lambda: fact_sales(
                clean["order_items"], clean["orders"], clean["order_payments"]
            ),
            "fact_order_fulfillment": lambda: fact_order_fulfillment(
                clean["orders"], clean["order_reviews"]
            ),
        }
    )
