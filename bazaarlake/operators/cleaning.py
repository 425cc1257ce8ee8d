"""Source tables to clean tables.

Inputs are arguments, so a table that depends on another (payments and
reviews on orders, products on the translation) cannot be built without it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import contracts as c
from bazaarlake.functions.dates import instant
from bazaarlake.functions.text import pad_zip, spaced, tidy
from bazaarlake.lazy import Plans
from bazaarlake.operators.dedupe import latest_per_key

ORDER_INSTANTS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _map(df: DataFrame, function, *columns: str) -> DataFrame:
    return df.withColumns({name: function(F.col(name)) for name in columns})


def clean_orders(orders: DataFrame) -> DataFrame:
    """Five instants; an order that is still open keeps its NULLs."""
    return _map(orders, instant, *ORDER_INSTANTS)


def clean_order_items(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "shipping_limit_date": instant(F.col("shipping_limit_date")),
            "price": F.col("price").try_cast("double"),
            "freight_value": F.col("freight_value").try_cast("double"),
        }
    )


def clean_customers(customers: DataFrame) -> DataFrame:
    padded = _map(customers, pad_zip, "customer_zip_code_prefix")
    return _map(padded, tidy, "customer_city", "customer_state")


def clean_sellers(sellers: DataFrame) -> DataFrame:
    padded = _map(sellers, pad_zip, "seller_zip_code_prefix")
    return _map(padded, tidy, "seller_city", "seller_state")


def clean_geolocation(points: DataFrame, *, one_per_zip: bool = False) -> DataFrame:
    """Distinct points per zip, or a lookup with one point per zip.

    Text is normalised before duplicates go, so spellings that differ only in
    case or padding count as one.
    """
    zip_col, lat, lng = c.RAW["geolocation"].keys
    tidied = _map(
        _map(points, pad_zip, zip_col), tidy, "geolocation_city", "geolocation_state"
    )
    keys = (zip_col,) if one_per_zip else (zip_col, lat, lng)
    return latest_per_key(tidied, keys)


def _known_orders(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of orders that exist, columns in their own order."""
    kept = df.join(orders.select("order_id"), "order_id", "left_semi")
    return kept.select(*df.columns)


def clean_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Spelled-out payment types, for known orders only."""
    relabelled = payments.replace(c.PAYMENT_TYPE_LABELS, subset=["payment_type"])
    return _known_orders(relabelled, orders)


def clean_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One latest answer per review, valid or missing score, known order."""
    typed = reviews.dropna(subset=["review_id", "order_id"]).withColumns(
        {
            "review_creation_date": instant(F.col("review_creation_date")),
            "review_answer_timestamp": instant(F.col("review_answer_timestamp")),
            "review_score": F.col("review_score").try_cast("int"),
        }
    )
    score = F.col("review_score")
    valid = score.isNull() | score.between(c.REVIEW_SCORE_MIN, c.REVIEW_SCORE_MAX)
    latest = latest_per_key(typed, ["review_id"], newest=["review_answer_timestamp"])
    filled = latest.filter(valid).fillna(
        {
            "review_comment_title": c.NO_REVIEW_TITLE,
            "review_comment_message": c.NO_REVIEW_MESSAGE,
        }
    )
    return _known_orders(filled, orders)


def clean_translation(translation: DataFrame) -> DataFrame:
    return _map(
        translation, spaced, "product_category_name", "product_category_name_english"
    )


def clean_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Readable category names with their English form, 'unknown' if none.

    ``translation`` is the clean table: both sides of the join use spaces.
    """
    named = _map(
        products.fillna({"product_category_name": c.UNKNOWN_CATEGORY}),
        spaced,
        "product_category_name",
    )
    english = "product_category_name_english"
    translated = named.join(translation, "product_category_name", "left")
    return translated.fillna({english: c.UNKNOWN_CATEGORY}).select(
        *named.columns, english
    )


def clean_all(raw: Mapping[str, DataFrame]) -> Plans:
    """All nine clean tables from the nine source tables."""
    clean = Plans(
        {
            "orders": lambda: clean_orders(raw["orders"]),
            "customers": lambda: clean_customers(raw["customers"]),
            "order_items": lambda: clean_order_items(raw["order_items"]),
            "order_payments": lambda: clean_payments(
                raw["order_payments"], clean["orders"]
            ),
            "order_reviews": lambda: clean_reviews(
                raw["order_reviews"], clean["orders"]
            ),
            "products": lambda: clean_products(
                raw["products"], clean["category_translation"]
            ),
            "sellers": lambda: clean_sellers(raw["sellers"]),
            "geolocation": lambda: clean_geolocation(raw["geolocation"]),
            "category_translation": lambda: clean_translation(
                raw["category_translation"]
            ),
        }
    )
    return clean
