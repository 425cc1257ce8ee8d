"""Growth, delivery, satisfaction, ranking, concentration and RFM analyses.

Analyses that look at one small table from several sides (ranks, shares,
scores) are split in two: a summary built once from facts or marts, and the
analysis of that summary. Between the two the caller writes the summary
(``bazaarlake.session.durable``), so that the large input is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.money import (
    amount,
    cents,
    mean_amount,
    mean_int,
    percent,
    ratio,
    sum_cents,
    sum_money,
)
from bazaarlake.functions.ranking import quantile_cuts, quantile_group, value_ranks


# ---- revenue ----


def revenue_by_period(sales: DataFrame) -> DataFrame:
    """Revenue and orders by month, quarter, year and in all, in one pass."""
    return (
        sales.rollup("year", "quarter", "month")
        .agg(
            _level("month", "quarter", "year", "all"),
            sum_money(F.col("total_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
        )
        .select("level", "year", "quarter", "month", "total_revenue", "total_orders")
    )


def revenue_by_geography(customers: DataFrame) -> DataFrame:
    """Revenue by city, by state and in all."""
    return (
        customers.rollup("customer_state", "customer_city")
        .agg(
            _level("city", "state", "all"),
            F.count("*").alias("customer_count"),
            sum_money(F.col("total_spent")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
        )
        .select(
            "level",
            "customer_state",
            "customer_city",
            "customer_count",
            "total_revenue",
            "total_orders",
        )
    )


def _level(*finest_first: str) -> Column:
    """Name of a rollup level: the grouping id is 2^k - 1 at level k."""
    label = F.when(F.grouping_id() == 0, finest_first[0])
    for k, name in enumerate(finest_first[1:], start=1):
        label = label.when(F.grouping_id() == 2**k - 1, name)
    return label.alias("level")


# ---- delivery and satisfaction ----


def _month_of(date_key: str) -> list[Column]:
    key = F.col(date_key)
    year, month = F.floor(key / 10000), F.floor(key / 100) % 100
    return [year.cast("int").alias("year"), month.cast("int").alias("month")]


def _delivery_sums() -> list[Column]:
    return [
        F.count("*").alias("_n"),
        F.sum("shipping_duration_days").alias("_days"),
        F.sum("delivery_delay_days").alias("_delay"),
        F.count("delivery_delay_days").alias("_delay_n"),
        F.sum("is_late_delivery").alias("_late"),
    ]


def _delivery_rates(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    n, late = F.sum("_n"), F.sum("_late")
    return sums.groupBy(*by).agg(
        n.alias("deliveries"),
        ratio(F.sum("_days"), n).alias("avg_shipping_days"),
        ratio(F.sum("_delay"), F.sum("_delay_n")).alias("avg_delay_days"),
        percent(late, n).alias("late_rate_pct"),
        percent(n - late, n).alias("on_time_rate_pct"),
    )


def _delivered(fulfillment: DataFrame) -> DataFrame:
    return fulfillment.filter(F.col("shipping_duration_days").isNotNull())


def delivery_by_month(fulfillment: DataFrame) -> DataFrame:
    """Shipping time and on-time rate by month of purchase."""
    by = ["year", "month"]
    sums = (
        _delivered(fulfillment)
        .drop(*by)  # a stored fact has them as partition columns
        .select("*", *_month_of("purchase_date_key"))
        .groupBy(*by)
        .agg(*_delivery_sums())
    )
    return _delivery_rates(sums, by)


def delivery_by_state(fulfillment: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Shipping time and on-time rate by customer state.

    Sums per customer come first, so the join sees a customer once however
    many orders they have.
    """
    sums = _delivered(fulfillment).groupBy("customer_id").agg(*_delivery_sums())
    placed = sums.join(dim_customers.select("customer_id", "customer_state"), "customer_id")
    return _delivery_rates(placed, ["customer_state"])


def delivery_by_seller_state(
    fulfillment: DataFrame, fact_sales: DataFrame, dim_sellers: DataFrame
) -> DataFrame:
    """Shipping time from seller to buyer, by state of the seller.

    An order counts once per seller it has lines from. Sums per order come
    first: an order with many reviews and many sellers must not be multiplied
    out.
    """
    shipped = fact_sales.select("seller_id", "order_id").distinct()
    per_order = _delivered(fulfillment).groupBy("order_id").agg(*_delivery_sums())
    sums = (
        shipped.join(per_order, "order_id")
        .groupBy("seller_id")
        .agg(*[F.sum(n).alias(n) for n in per_order.columns if n != "order_id"])
    )
    placed = sums.join(dim_sellers.select("seller_id", "seller_state"), "seller_id")
    return _delivery_rates(placed, ["seller_state"])


def review_trend(fulfillment: DataFrame) -> DataFrame:
    """Review scores by month of purchase."""
    score = F.col("review_score")
    return (
        fulfillment.filter(score.isNotNull())
        .groupBy(*_month_of("purchase_date_key"))
        .agg(F.count("*").alias("reviews"), mean_int(score).alias("avg_review_score"))
    )


def review_delay_correlation(fulfillment: DataFrame) -> DataFrame:
    """One row: how review scores go with lateness, over scored deliveries."""
    score, delay = F.col("review_score"), F.col("delivery_delay_days")
    late = F.col("is_late_delivery") == 1
    return fulfillment.filter(score.isNotNull() & delay.isNotNull()).agg(
        F.count("*").alias("reviews"),
        F.round(F.corr(delay.cast("double"), score.cast("double")), 6).alias(
            "delay_score_corr"
        ),
        mean_int(F.when(late, score)).alias("avg_score_late"),
        mean_int(F.when(~late, score)).alias("avg_score_on_time"),
    )


# ---- products and sellers ----


def product_extremes(products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with most and the ``k`` with least revenue."""
    shown = products.select("product_id", "category", "total_sales", "total_quantity")

    def end(label: str, order: Column) -> DataFrame:
        return (
            shown.orderBy(order, F.asc("product_id"))
            .limit(k)
            .select(F.lit(label).alias("side"), "*")
        )

    return end("highest", F.desc_nulls_last("total_sales")).unionByName(
        end("lowest", F.asc_nulls_last("total_sales"))
    )


def seller_summary(
    fact_sales: DataFrame, fulfillment: DataFrame, dim_sellers: DataFrame
) -> DataFrame:
    """Orders, revenue and review scores per seller.

    Reviews belong to orders, so they are added per (seller, order): an order
    with many lines of one seller counts its reviews once.
    """
    sold = fact_sales.groupBy("seller_id", "order_id").agg(
        sum_cents(F.col("total_item_value")).alias("_cents")
    )
    scored = (
        fulfillment.filter(F.col("review_score").isNotNull())
        .groupBy("order_id")
        .agg(F.sum("review_score").alias("_score"), F.count("*").alias("_reviews"))
    )
    per_seller = (
        sold.join(scored, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            amount(F.sum("_cents")).alias("total_revenue"),
            F.coalesce(F.sum("_reviews"), F.lit(0)).alias("review_count"),
            ratio(F.sum("_score"), F.sum("_reviews")).alias("avg_review_score"),
        )
    )
    return per_seller.join(
        dim_sellers.select("seller_id", "seller_state"), "seller_id", "left"
    )


def seller_ranking(summary: DataFrame) -> DataFrame:
    """Dense ranks of sellers by number of orders and by mean review score."""
    scored = summary.withColumn("_score", cents(F.col("avg_review_score")))

    def ranks(value: str, name: str) -> DataFrame:
        return value_ranks(scored, value, descending=True).select(
            value, F.col("dense_rank_no").alias(name)
        )

    return (
        scored.join(ranks("total_orders", "order_rank"), "total_orders", "left")
        .join(ranks("_score", "review_rank"), "_score", "left")
        .select(
            "seller_id",
            "seller_state",
            "total_orders",
            "total_revenue",
            "review_count",
            "avg_review_score",
            "order_rank",
            "review_rank",
        )
    )


# ---- customers ----


def place_summary(customers: DataFrame, *by: str) -> DataFrame:
    """Customers and revenue per place (state, or state and city)."""
    return customers.groupBy(*by).agg(
        F.count("*").alias("customer_count"),
        sum_cents(F.col("total_spent")).alias("revenue_cents"),
    )


def concentration(places: DataFrame, *by: str) -> DataFrame:
    """Share of customers and revenue per place, and the running share.

    ``cumulative_revenue_pct`` adds up all places with at least this revenue.
    """
    totals = places.agg(
        F.sum("customer_count").alias("n"),
        F.sum(F.col("revenue_cents").cast("decimal(28,0)")).alias("c"),
    )
    all_customers = totals.select("n").scalar()
    all_cents = totals.select("c").scalar()
    ranks = value_ranks(
        places, "revenue_cents", descending=True, total="revenue_cents"
    ).select("revenue_cents", "rank_no", "running_total")
    # A place without any revenue value has no rank, but it stays.
    return places.join(ranks, "revenue_cents", "left").select(
        *by,
        "customer_count",
        amount(F.col("revenue_cents")).alias("total_revenue"),
        percent(F.col("customer_count"), all_customers).alias("customer_share_pct"),
        percent(F.col("revenue_cents").cast("decimal(28,0)"), all_cents).alias(
            "revenue_share_pct"
        ),
        percent(F.col("running_total"), all_cents).alias("cumulative_revenue_pct"),
        F.col("rank_no").alias("revenue_rank"),
    )


def customer_value(customers: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Last purchase, order count and spending per person."""
    last = F.max("last_purchase_date_key")
    return (
        customers.groupBy(key)
        .agg(
            F.to_date(last.cast("string"), "yyyyMMdd").alias("last_purchase_date"),
            F.sum("total_orders").alias("frequency"),
            sum_cents(F.col("total_spent")).alias("monetary_cents"),
        )
    )


# Segment rules, on scores 1 (worst) to 5 (best).
RFM_GROUPS = 5


def rfm_segments(values: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Recency, frequency and monetary scores per person, and their segment.

    Recency counts days to the latest purchase of all. People with equal
    values get equal scores.
    """
    latest = values.agg(F.max("last_purchase_date")).scalar()
    aged = values.withColumn(
        "recency_days", F.datediff(latest, F.col("last_purchase_date"))
    )

    def score(column: str) -> Column:
        cuts = quantile_cuts(aged, column, RFM_GROUPS)
        return quantile_group(F.col(column), cuts, RFM_GROUPS)

    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP")
        .when((r >= 4) & (F.col("frequency") == 1), "New")
        .when((r <= 2) & ((f >= 3) | (m >= 3)), "At risk")
        .otherwise("Regular")
    )
    return aged.select(
        key,
        "recency_days",
        "frequency",
        amount(F.col("monetary_cents")).alias("monetary"),
        (RFM_GROUPS + 1 - score("recency_days")).alias("r_score"),
        score("frequency").alias("f_score"),
        score("monetary_cents").alias("m_score"),
    ).withColumn("segment", segment)


def segment_sizes(segments: DataFrame) -> DataFrame:
    """People and spending per RFM segment."""
    return segments.groupBy("segment").agg(
        F.count("*").alias("people"),
        sum_money(F.col("monetary")).alias("total_monetary"),
        mean_amount(sum_cents(F.col("monetary")), F.count("*")).alias("avg_monetary"),
    )
