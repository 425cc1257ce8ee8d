"""Table contracts: explicit schemas, keys and fixed values.

Schemas are DDL text so that they read like the table definitions they are.
Instants are ``timestamp_ntz``: calendar arithmetic on them does not depend on
the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "platinum")


@dataclass(frozen=True)
class Contract:
    """Name, column types and key columns of one table.

    ``multi_line``: text fields of its CSV form may hold line breaks.
    """

    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    multi_line: bool = False

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _index(*contracts: Contract) -> dict[str, Contract]:
    return {c.name: c for c in contracts}


# Source tables, in the order a load visits them.
RAW = _index(
    Contract(
        "orders",
        """order_id string, customer_id string, order_status string,
           order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
           order_delivered_carrier_date timestamp_ntz,
           order_delivered_customer_date timestamp_ntz,
           order_estimated_delivery_date timestamp_ntz""",
        ("order_id",),
    ),
    Contract(
        "customers",
        """customer_id string, customer_unique_id string,
           customer_zip_code_prefix string, customer_city string,
           customer_state string""",
        ("customer_id",),
    ),
    Contract(
        "order_items",
        """order_id string, order_item_id int, product_id string,
           seller_id string, shipping_limit_date timestamp_ntz, price double,
           freight_value double""",
        ("order_id", "order_item_id"),
    ),
    Contract(
        "order_payments",
        """order_id string, payment_sequential int, payment_type string,
           payment_installments int, payment_value double""",
        ("order_id", "payment_sequential"),
    ),
    Contract(
        "order_reviews",
        """review_id string, order_id string, review_score int,
           review_comment_title string, review_comment_message string,
           review_creation_date timestamp_ntz,
           review_answer_timestamp timestamp_ntz""",
        ("review_id",),
        multi_line=True,
    ),
    Contract(
        "products",
        """product_id string, product_category_name string,
           product_name_lenght int, product_description_lenght int,
           product_photos_qty int, product_weight_g double,
           product_length_cm double, product_height_cm double,
           product_width_cm double""",
        ("product_id",),
    ),
    Contract(
        "sellers",
        """seller_id string, seller_zip_code_prefix string, seller_city string,
           seller_state string""",
        ("seller_id",),
    ),
    Contract(
        "geolocation",
        """geolocation_zip_code_prefix string, geolocation_lat double,
           geolocation_lng double, geolocation_city string,
           geolocation_state string""",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    ),
    Contract(
        "category_translation",
        "product_category_name string, product_category_name_english string",
        ("product_category_name",),
    ),
)

# Star schema.
GOLD = _index(
    Contract(
        "dim_products",
        """product_id string, product_category_pt string,
           product_category_en string, product_weight_g double,
           product_length_cm double, product_height_cm double,
           product_width_cm double""",
        ("product_id",),
    ),
    Contract(
        "dim_sellers",
        """seller_id string, seller_city string, seller_state string,
           seller_zip_code_prefix string, seller_lat double, seller_lng double""",
        ("seller_id",),
    ),
    Contract(
        "dim_customers",
        """customer_id string, customer_unique_id string, customer_city string,
           customer_state string, customer_zip_code_prefix string,
           customer_lat double, customer_lng double""",
        ("customer_id",),
    ),
    Contract(
        "dim_date",
        """date_key int, full_date date, day_of_month int, day_of_week int,
           day_name string, month int, quarter int, year int,
           is_weekend boolean""",
        ("date_key",),
    ),
    Contract(
        "fact_sales",
        """order_id string, order_item_id int, product_id string,
           seller_id string, customer_id string, order_status string,
           purchase_date_key int, price double, freight_value double,
           total_item_value double, total_payment_value double""",
        ("order_id", "order_item_id"),
    ),
    Contract(
        "fact_order_fulfillment",
        """order_id string, customer_id string, review_id string,
           order_status string, review_score int, purchase_date_key int,
           estimated_delivery_date_key int, actual_delivery_date_key int,
           delivery_delay_days int, shipping_duration_days int,
           is_late_delivery int""",
        ("order_id", "review_id"),
    ),
)

# Marts. Column order is the contract of the registered external tables.
PLATINUM = _index(
    Contract(
        "sales_summary_mart",
        """purchase_date_key int, full_date date, year int, month int,
           quarter int, day_of_week int, day_name string, is_weekend boolean,
           total_revenue double, total_payment double, total_orders bigint,
           total_items bigint, avg_order_value double, avg_item_price double,
           total_freight double, revenue_day_growth_pct double""",
        ("purchase_date_key",),
    ),
    Contract(
        "customer_mart",
        """customer_id string, customer_unique_id string, customer_city string,
           customer_state string, customer_zip_code_prefix string,
           total_orders bigint, total_spent double, avg_order_value double,
           total_items_purchased bigint, total_freight_paid double,
           avg_item_price double, last_purchase_date_key int,
           last_purchase_date date, is_repeat_customer int""",
        ("customer_id",),
    ),
    Contract(
        "product_mart",
        """product_id string, category string, total_sales double,
           total_quantity bigint, total_orders bigint, avg_price double,
           avg_freight double, total_freight double, product_weight_g double,
           product_length_cm double, product_height_cm double,
           product_width_cm double""",
        ("product_id",),
    ),
    Contract(
        "kpi_summary",
        """total_revenue double, total_orders bigint, total_items bigint,
           total_customers bigint, total_sellers bigint, total_products bigint,
           avg_order_value double, revenue_per_customer double,
           avg_delivery_time_days double, avg_delivery_delay_days double,
           late_delivery_rate_pct double, on_time_delivery_rate_pct double,
           avg_review_score double, positive_review_rate_pct double,
           total_reviews bigint, repeat_customer_count bigint,
           repeat_customer_rate_pct double""",
    ),
)

# ---- Fixed values (must equal the source system's for right results) ----

# Payment type spellings; anything else passes through unchanged.
PAYMENT_TYPE_LABELS = {
    "credit_card": "credit card",
    "debit_card": "debit card",
    "not_defined": "not defined",
}

# Text defaults.
UNKNOWN_CATEGORY = "unknown"
NO_REVIEW_TITLE = "No Title"
NO_REVIEW_MESSAGE = "No Message"

# Valid review scores, and the lowest score counted as a positive review.
REVIEW_SCORE_MIN, REVIEW_SCORE_MAX = 1, 5
POSITIVE_SCORE = 4

# Zip prefixes are five characters, zero-padded on the left.
ZIP_WIDTH = 5

# Spark day-of-week numbers of Sunday and Saturday.
WEEKEND_DAYS = (1, 7)

# Spending tiers: (lowest total spent, label), then the label of the rest.
SPENDING_TIERS = (
    (1000, "High (1000+)"),
    (500, "Medium (500-999)"),
    (100, "Low (100-499)"),
)
SPENDING_TIER_REST = "Minimal (<100)"

# Weight tiers in grams: (lowest weight, label), then the label of the rest.
WEIGHT_TIERS = (
    (10000, "Heavy (10kg+)"),
    (5000, "Medium (5-10kg)"),
    (1000, "Light (1-5kg)"),
)
WEIGHT_TIER_REST = "Very Light (<1kg)"
