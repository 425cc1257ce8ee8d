"""Star schema, marts and insights on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from bazaarlake.contracts import GOLD, PLATINUM
from bazaarlake.plans import gold, insights, marts, reports, views

ORDERS = """order_id string, customer_id string, order_status string,
    order_purchase_timestamp timestamp_ntz,
    order_delivered_customer_date timestamp_ntz,
    order_estimated_delivery_date timestamp_ntz"""
ITEMS = """order_id string, order_item_id int, product_id string, seller_id string,
    price double, freight_value double"""
PAYMENTS = "order_id string, payment_value double"
REVIEWS = "order_id string, review_id string, review_score int"
FACT = GOLD["fact_sales"].ddl
FULFILLMENT = GOLD["fact_order_fulfillment"].ddl


def _order(key, day, delivered=None, estimated=datetime(2018, 1, 10)):
    return (key, f"c{key}", "delivered", day, delivered, estimated)


def _line(order, day, value, *, item=1, customer="c1", product="p1", paid=None):
    return (
        order, item, product, "s1", customer, "delivered", day, value, 0.0, value, paid,
    )


@pytest.fixture
def calendar(table):
    bounds = table("first_day date, last_day date", (date(2018, 1, 1), date(2018, 12, 31)))
    return gold.dim_date(bounds)


def test_dim_date_contract(calendar):
    assert calendar.count() == 365
    assert [f.simpleString() for f in calendar.schema] == [
        f.simpleString() for f in GOLD["dim_date"].schema
    ]


def test_split_payment_repeats_its_sum_on_every_line(table, rows):
    orders = table(ORDERS, _order("1", datetime(2018, 1, 1)))
    items = table(ITEMS, *[("1", i, "p", "s", 10.0, 1.005) for i in (1, 2, 3)])
    payments = table(PAYMENTS, ("1", 20.1), ("1", 0.2))
    fact = gold.fact_sales(items, orders, payments)
    assert fact.columns == GOLD["fact_sales"].columns
    got = fact.select(
        "order_item_id", "freight_value", "total_item_value", "total_payment_value"
    )
    assert rows(got) == [(i, 1.01, 11.0, 20.3) for i in (1, 2, 3)]


def test_lines_without_order_drop_and_without_payment_stay(table, rows):
    orders = table(ORDERS, _order("1", datetime(2018, 1, 1)))
    items = table(ITEMS, ("1", 1, "p", "s", 1.0, 1.0), ("9", 1, "p", "s", 1.0, 1.0))
    fact = gold.fact_sales(items, orders, table(PAYMENTS))
    assert rows(fact.select("order_id", "total_payment_value")) == [("1", None)]


def test_fulfillment(table):
    bought = datetime(2018, 1, 1, 23, 50)
    orders = table(
        ORDERS,
        _order("late", bought, datetime(2018, 1, 12)),
        _order("early", bought, datetime(2018, 1, 2, 0, 10)),
        _order("open", bought),
    )
    reviews = table(REVIEWS, ("late", "r1", 1), ("late", "r2", 2), ("gone", "r3", 3))
    got = gold.fact_order_fulfillment(orders, reviews)
    assert got.columns == GOLD["fact_order_fulfillment"].columns
    seen = {
        (r.order_id, r.review_id): (
            r.delivery_delay_days,
            r.shipping_duration_days,
            r.is_late_delivery,
        )
        for r in got.collect()
    }
    assert seen == {
        ("late", "r1"): (2, 11, 1),
        ("late", "r2"): (2, 11, 1),
        ("early", None): (-8, 1, 0),
        ("open", None): (None, None, 0),
    }


def test_centroid_averages_all_points(table):
    points = table(
        "geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double",
        ("00001", 1.0, -1.0),
        ("00001", 2.0, -2.0),
        ("00001", None, None),
        ("00002", None, None),
    )
    got = {r[0]: (r[1], r[2]) for r in gold.geo_centroid(points).collect()}
    assert got == {"00001": (1.5, -1.5), "00002": (None, None)}


def test_unmatched_category_is_null_in_the_dimension(table):
    products = table(
        """product_id string, product_category_name string, product_weight_g int,
           product_length_cm int, product_height_cm int, product_width_cm int,
           product_category_name_english string""",
        ("1", "odd", 1, 2, 3, 4, "unknown"),
    )
    names = table("product_category_name string, product_category_name_english string")
    dim = gold.dim_products(products, names)
    assert dim.first().product_category_en is None
    assert dim.first().product_weight_g == 1.0
    filled = gold.dim_products(products, names, unknown_label="unknown")
    assert filled.first().product_category_en == "unknown"


def test_daily_mart_drops_days_outside_the_calendar(table, calendar):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0, paid=30.0),
        _line("1", 20180101, 20.0, item=2, paid=30.0),
        _line("2", 20180105, 45.0),
        _line("3", 20190101, 99.0),
        _line("4", None, 99.0),
    )
    got = marts.sales_summary_mart(fact, calendar)
    assert got.columns == PLATINUM["sales_summary_mart"].columns
    days = {r.purchase_date_key: r for r in got.collect()}
    assert set(days) == {20180101, 20180105}
    first, second = days[20180101], days[20180105]
    assert (first.total_revenue, first.total_orders, first.total_items) == (30.0, 1, 2)
    assert (first.total_payment, first.avg_order_value) == (60.0, 30.0)
    assert (first.avg_item_price, first.revenue_day_growth_pct) == (15.0, None)
    assert (second.total_payment, second.revenue_day_growth_pct) == (None, 50.0)
    once = marts.sales_summary_mart(fact, calendar, payments_once=True)
    assert {r.purchase_date_key: r.total_payment_orders for r in once.collect()} == {
        20180101: 30.0,
        20180105: None,
    }


def test_densified_growth_wants_the_day_before(table, calendar):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("2", 20180102, 15.0),
        _line("3", 20180105, 45.0),
    )
    got = marts.sales_summary_mart(fact, calendar, densify=True)
    assert {r.purchase_date_key: r.revenue_day_growth_pct for r in got.collect()} == {
        20180101: None,
        20180102: 50.0,
        20180105: None,
    }


def test_repeat_customers_by_person(table, customers):
    fact = table(
        FACT, _line("1", 20180101, 10.0), _line("2", 20180102, 5.0, customer="c2")
    )
    lines = marts.with_person(fact, customers)
    by_id = marts.kpi_summary(lines, table(FULFILLMENT)).first()
    by_person = marts.kpi_summary(
        lines, table(FULFILLMENT), customer_key="customer_unique_id"
    ).first()
    assert (by_id.total_customers, by_id.repeat_customer_count) == (2, 0)
    assert (by_person.total_customers, by_person.repeat_customer_count) == (1, 1)


@pytest.fixture
def customers(table):
    return table(
        GOLD["dim_customers"].ddl,
        ("c1", "u1", "city", "st", "00001", None, None),
        ("c2", "u1", "city", "st", "00001", None, None),
        ("idle", "u2", "city", "st", "00001", None, None),
    )


def test_customer_mart_keeps_purchases_outside_the_calendar(table, calendar, customers):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("2", 20190101, 5.55),
        _line("3", 20180105, 1.0, customer="c2"),
        _line("4", 20180105, 1.0, customer="unknown"),
    )
    got = {r.customer_id: r for r in marts.customer_mart(fact, customers, calendar).collect()}
    assert set(got) == {"c1", "c2"}
    c1, c2 = got["c1"], got["c2"]
    assert (c1.total_orders, c1.total_spent, c1.avg_order_value) == (2, 15.55, 7.78)
    assert (c1.last_purchase_date_key, c1.last_purchase_date) == (20190101, None)
    assert (c1.is_repeat_customer, c2.is_repeat_customer) == (1, 0)
    assert c2.last_purchase_date == date(2018, 1, 5)


def test_product_mart(table):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("1", 20180101, 5.0, item=2),
        _line("2", 20180101, 1.0, product="unlisted"),
    )
    dim = table(GOLD["dim_products"].ddl, ("p1", "x", None, 1.0, 2.0, 3.0, 4.0))
    (got,) = marts.product_mart(fact, dim).collect()
    assert (got.total_sales, got.total_quantity, got.total_orders) == (15.0, 2, 1)
    assert (got.avg_price, got.category) == (7.5, None)


def _delivery(order, score, delay, days, late):
    return (order, "c1", f"r{order}", "delivered", score, 20180101, None, None,
            delay, days, late)


def test_kpis(table):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("2", 20180101, 10.0),
        _line("3", 20180101, 5.0, customer="c2", product="p2"),
    )
    shipped = table(
        FULFILLMENT,
        _delivery("1", 5, 2, 10, 1),
        _delivery("2", 4, -1, 5, 0),
        _delivery("3", 1, -1, 5, 0),
        _delivery("4", None, None, None, 0),
    )
    got = marts.kpi_summary(fact, shipped).first().asDict()
    assert got == {
        "total_revenue": 25.0,
        "total_orders": 3,
        "total_items": 3,
        "total_customers": 2,
        "total_sellers": 1,
        "total_products": 2,
        "avg_order_value": 8.33,
        "revenue_per_customer": 12.5,
        "avg_delivery_time_days": 6.67,
        "avg_delivery_delay_days": 0.0,
        "late_delivery_rate_pct": 33.33,
        "on_time_delivery_rate_pct": 66.67,
        "avg_review_score": 3.33,
        "positive_review_rate_pct": 66.67,
        "total_reviews": 3,
        "repeat_customer_count": 1,
        "repeat_customer_rate_pct": 50.0,
    }


def test_kpis_of_nothing(table):
    got = marts.kpi_summary(table(FACT), table(FULFILLMENT)).first().asDict()
    counts = {"total_orders", "total_items", "total_customers", "total_sellers",
              "total_products", "total_reviews", "repeat_customer_count"}
    assert got == {k: 0 if k in counts else None for k in got}


def test_marts_have_no_python_and_no_cross_join(table, calendar, customers):
    fact, shipped = table(FACT), table(FULFILLMENT)
    dim = table(GOLD["dim_products"].ddl)
    for mart in (
        marts.sales_summary_mart(fact, calendar),
        marts.customer_mart(fact, customers, calendar),
        marts.product_mart(fact, dim),
        marts.kpi_summary(fact, shipped),
    ):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        for bad in ("Python", "CartesianProduct", "NestedLoop"):
            assert bad not in plan


def test_seller_reviews_count_once_per_order(table):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("1", 20180101, 10.0, item=2),
        _line("2", 20180101, 1.0),
    )
    shipped = table(FULFILLMENT, _delivery("1", 1, 0, 1, 0), _delivery("2", 4, 0, 1, 0))
    dim = table(GOLD["dim_sellers"].ddl, ("s1", "city", "st", "00001", None, None))
    (got,) = insights.seller_summary(fact, shipped, dim).collect()
    assert (got.total_orders, got.review_count, got.avg_review_score) == (2, 2, 2.5)


def test_delivery_counts_once_per_seller_and_review(table):
    fact = table(
        FACT,
        _line("1", 20180101, 10.0),
        _line("1", 20180101, 10.0, item=2),
        _line("2", 20180101, 1.0),
    )
    shipped = table(
        FULFILLMENT,
        _delivery("1", 1, 2, 10, 1),
        _delivery("1", 5, 2, 10, 1),
        _delivery("2", 4, -3, 4, 0),
        _delivery("3", 4, -3, 4, 0),
    )
    dim = table(GOLD["dim_sellers"].ddl, ("s1", "city", "st", "00001", None, None))
    (got,) = insights.delivery_by_seller_state(shipped, fact, dim).collect()
    assert (got.deliveries, got.avg_shipping_days) == (3, 8.0)
    assert (got.avg_delay_days, got.late_rate_pct) == (0.33, 66.67)


def test_seller_ranks_are_dense_and_unreviewed_sellers_have_none(table):
    ddl = """seller_id string, total_orders bigint, total_revenue double,
             review_count bigint, avg_review_score double, seller_state string"""
    summary = table(
        ddl,
        ("a", 9, 1.0, 1, 5.0, "x"),
        ("b", 9, 1.0, 1, 3.0, "x"),
        ("c", 2, 1.0, 0, None, None),
    )
    got = insights.seller_ranking(summary).collect()
    assert {r.seller_id: (r.order_rank, r.review_rank) for r in got} == {
        "a": (1, 1),
        "b": (1, 2),
        "c": (2, None),
    }


def test_rfm_segments(table):
    rows = [(f"u{i}", date(2018, 12, 31 - i), 10 - i, 1000 * (10 - i)) for i in range(10)]
    rows.append(("fresh", date(2018, 12, 31), 1, 50))
    values = table(
        "customer_unique_id string, last_purchase_date date, frequency bigint, "
        "monetary_cents bigint",
        *rows,
    )
    got = {r[0]: r for r in insights.rfm_segments(values).collect()}
    assert got["u0"].segment == "VIP" and got["u0"].recency_days == 0
    assert got["fresh"].segment == "New"
    assert got["u9"].segment == "Regular"
    assert {r.r_score for r in got.values()} == {1, 2, 3, 4, 5}
    sizes = insights.segment_sizes(insights.rfm_segments(values))
    assert sizes.agg(F.sum("people")).first()[0] == len(rows)


def test_concentration_adds_up(table):
    places = table(
        "customer_state string, customer_count bigint, revenue_cents bigint",
        ("a", 5, 600),
        ("b", 3, 300),
        ("c", 2, 100),
    )
    got = insights.concentration(places, "customer_state").collect()
    assert {
        r.customer_state: (r.revenue_share_pct, r.cumulative_revenue_pct, r.revenue_rank)
        for r in got
    } == {"a": (60.0, 60.0, 1), "b": (30.0, 90.0, 2), "c": (10.0, 100.0, 3)}


def test_views_agree_with_reports(spark, table):
    sales = table(
        PLATINUM["sales_summary_mart"].ddl,
        *[
            (20180100 + d, date(2018, 1, d), 2018, 1, 1, 1, "x", d in (6, 7),
             10.25 * d, None, d, d, 10.25, 10.25, 0.01, None)
            for d in range(1, 8)
        ],
    )
    given = {"sales_summary_mart": sales}
    view = views.view_query(spark, "vw_monthly_sales", given)
    assert view.collect() == reports.monthly_revenue(sales).collect()
    week = views.view_query(spark, "vw_weekday_weekend", given)
    report = reports.weekend_vs_weekday(sales).drop("avg_item_price")
    assert sorted(week.collect()) == sorted(report.collect())


def test_top_lists_break_ties_and_put_nulls_last(table):
    ddl = PLATINUM["product_mart"].ddl
    mart = table(
        ddl,
        *[(p, None, s, 1, 1, 1.0, 1.0, 1.0, None, None, None, None)
          for p, s in (("b", 2.0), ("a", 2.0), ("n", None), ("c", 9.0))],
    )
    top = reports.top_products(mart, 4)
    assert [r.product_id for r in top.collect()] == ["c", "a", "b", "n"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
