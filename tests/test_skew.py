"""One key holds a third of the rows: joins split it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators.cleaning import clean_payments
from bazaarlake.plans import gold

N = 120_000


@pytest.fixture
def small_partitions(settings):
    """Thresholds at which test data counts as skewed; no broadcasts."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )


def _hot(spark, n=N):
    """``n`` rows, a third of them of order 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000)
    return spark.range(0, n, 1, 8).select(key.cast("string").alias("order_id"), "id")


def _orders(spark, n=20_000):
    day = F.lit("2018-01-01").cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.col("id").cast("string").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        day.alias("order_delivered_customer_date"),
        day.alias("order_estimated_delivery_date"),
    )


def _final_plan(df):
    """The plan as it really ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_sales_splits_a_hot_order(spark, small_partitions):
    items = _hot(spark).select(
        "order_id",
        F.col("id").cast("int").alias("order_item_id"),
        F.col("id").cast("string").alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit(1.0).alias("price"),
        F.lit(0.5).alias("freight_value"),
    )
    payments = _orders(spark).select("order_id", F.lit(2.0).alias("payment_value"))
    fact = gold.fact_sales(items, _orders(spark), payments)
    plan = _final_plan(fact)
    # The one join that the lines take part in is split.
    assert plan.count("skew=true") >= 1
    assert "SortMergeJoin(skew=true) [order_id" in plan
    totals = fact.agg(F.count("*"), F.sum("total_item_value")).first()
    assert tuple(totals) == (N, N * 1.5)


def test_fulfillment_splits_a_hot_reviewed_order(spark, small_partitions):
    reviews = _hot(spark).select(
        "order_id",
        F.col("id").cast("string").alias("review_id"),
        F.lit(5).alias("review_score"),
    )
    orders = _orders(spark, 20_050)
    fact = gold.fact_order_fulfillment(orders, reviews)
    assert "skew=true" in _final_plan(fact)
    unreviewed = orders.join(reviews, "order_id", "left_anti").count()
    assert fact.count() == N + unreviewed
    assert fact.filter("review_id IS NULL").count() == unreviewed


@pytest.mark.parametrize("role", ["customer", "seller"])
def test_a_hot_zip_is_split(spark, small_partitions, role):
    hot = F.when(F.col("id") % 3 == 0, "00000").otherwise(
        F.lpad((F.col("id") % 20_000).cast("string"), 5, "0")
    )
    people = spark.range(0, N, 1, 8).select(
        F.col("id").cast("string").alias("id"), hot.alias(f"{role}_zip_code_prefix")
    )
    points = spark.range(0, 40_000, 1, 8).select(
        F.lpad((F.col("id") % 20_000).cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        F.lit(1.0).alias("geolocation_lat"),
        F.col("id").cast("double").alias("geolocation_lng"),
    )
    located = gold._located(people, points, role)
    assert "skew=true" in _final_plan(located)
    assert located.count() == N
    assert located.filter(f"{role}_lat IS NULL").count() == 0


def test_semi_join_splits_a_hot_order(spark, small_partitions):
    payments = _hot(spark).select("order_id", F.lit("boleto").alias("payment_type"), "id")
    kept = clean_payments(payments, _orders(spark))
    assert "skew=true" in _final_plan(kept)
    assert kept.count() == N


def test_hot_group_is_reduced_before_the_shuffle(spark):
    totals = gold.order_payment_totals(
        _hot(spark).select("order_id", F.lit(0.01).alias("payment_value"))
    )
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
    assert totals.filter("order_id = '0'").first()[1] == pytest.approx(
        0.01 * (N // 3 + N // 20_000 - (N // 20_000) // 3)
    )
