import itertools
from datetime import datetime

from pyspark.sql import functions as F

from bazaarlake.contracts import PLATINUM
from bazaarlake.operators import cleaning
from bazaarlake.operators.dedupe import latest_per_key
from bazaarlake.operators.schema import conform, normalize_types


def _orders(table, *ids):
    return table("order_id string", *[(i,) for i in ids])


def test_open_orders_keep_their_nulls(table):
    raw = table(
        """order_id string, order_purchase_timestamp string, order_approved_at string,
           order_delivered_carrier_date string, order_delivered_customer_date string,
           order_estimated_delivery_date string""",
        ("1", "2018-01-02 03:04:05", None, None, "garbage", "2018-02-01"),
    )
    got = cleaning.clean_orders(raw).first()
    assert got.order_purchase_timestamp == datetime(2018, 1, 2, 3, 4, 5)
    assert got.order_approved_at is None
    assert got.order_delivered_customer_date is None
    assert got.order_estimated_delivery_date == datetime(2018, 2, 1)


def test_items_cast(table):
    raw = table(
        "order_id string, shipping_limit_date string, price string, freight_value string",
        ("1", "2018-01-01", "10.5", "x"),
    )
    got = cleaning.clean_order_items(raw).first()
    assert (got.price, got.freight_value) == (10.5, None)


def test_places_are_tidied(table):
    customers = table(
        "customer_id string, customer_zip_code_prefix int, customer_city string, "
        "customer_state string",
        ("1", 1310, " Sao Paulo", "SP "),
    )
    got = cleaning.clean_customers(customers).first()
    assert tuple(got) == ("1", "01310", "sao paulo", "sp")
    sellers = table(
        "seller_id string, seller_zip_code_prefix int, seller_city string, "
        "seller_state string",
        ("1", 99, "X", None),
    )
    assert tuple(cleaning.clean_sellers(sellers).first()) == ("1", "00099", "x", None)


def test_geolocation_spellings_count_once(table, rows):
    raw = table(
        "geolocation_zip_code_prefix int, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string",
        (1310, 1.0, 2.0, "Sao Paulo", "SP"),
        (1310, 1.0, 2.0, " sao paulo ", "sp"),
        (1310, 1.5, 2.0, "sao paulo", "SP"),
    )
    assert rows(cleaning.clean_geolocation(raw)) == [
        ("01310", 1.0, 2.0, "sao paulo", "sp"),
        ("01310", 1.5, 2.0, "sao paulo", "sp"),
    ]
    assert rows(cleaning.clean_geolocation(raw, one_per_zip=True)) == [
        ("01310", 1.5, 2.0, "sao paulo", "sp")
    ]


def test_payments_are_relabelled_and_orphans_dropped(table, rows):
    raw = table(
        "order_id string, payment_type string",
        ("1", "credit_card"),
        ("1", "boleto"),
        ("2", "not_defined"),
        ("2", None),
        ("9", "debit_card"),
    )
    got = rows(cleaning.clean_payments(raw, _orders(table, "1", "2")))
    assert got == [
        ("1", "boleto"),
        ("1", "credit card"),
        ("2", "not defined"),
        ("2", None),
    ]


REVIEW_DDL = """review_id string, order_id string, review_score string,
    review_comment_title string, review_comment_message string,
    review_creation_date string, review_answer_timestamp string"""


def test_reviews(table):
    def review(key, order, score, answered, title=None):
        return (key, order, score, title, None, "2018-01-01", answered)

    raw = table(
        REVIEW_DDL,
        review("low", "1", "0", "2018-01-02"),
        review("high", "1", "6", "2018-01-02"),
        review("none", "1", None, "2018-01-02", "kept"),
        review("text", "1", "x", "2018-01-02"),
        review("twice", "1", "1", "2018-01-02"),
        review("twice", "1", "5", "2018-01-09"),
        review("turned bad", "1", "3", "2018-01-02"),
        review("turned bad", "1", "7", "2018-01-03"),
        review("orphan", "9", "3", "2018-01-02"),
        review(None, "1", "3", "2018-01-02"),
        review("no order", None, "3", "2018-01-02"),
    )
    got = cleaning.clean_reviews(raw, _orders(table, "1"))
    assert got.columns == raw.columns
    assert {r.review_id: r.review_score for r in got.collect()} == {
        "none": None,
        "text": None,
        "twice": 5,
    }
    titles = {r.review_id: r.review_comment_title for r in got.collect()}
    assert titles == {"none": "kept", "text": "No Title", "twice": "No Title"}


def test_categories_match_only_with_spaces_on_both_sides(table):
    products = table(
        "product_id string, product_category_name string",
        ("1", "cama_mesa_banho"),
        ("2", "sem_nome"),
        ("3", None),
    )
    raw = table(
        "product_category_name string, product_category_name_english string",
        ("cama_mesa_banho", "bed_bath_table"),
    )
    got = cleaning.clean_products(products, cleaning.clean_translation(raw))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {
        "1": ("cama mesa banho", "bed bath table"),
        "2": ("sem nome", "unknown"),
        "3": ("unknown", "unknown"),
    }


def test_latest_per_key_does_not_depend_on_input_order(table):
    data = [("a", 1, None), ("a", 1, "x"), ("a", None, "z"), ("b", None, None)]
    seen = set()
    for order in itertools.permutations(data):
        df = table("k string, t int, v string", *order).repartition(3)
        seen.add(frozenset(latest_per_key(df, ["k"], ["t"]).collect()))
    assert seen == {frozenset({("a", 1, "x"), ("b", None, None)})}


def test_latest_per_key_reduces_before_the_shuffle(table):
    df = table("k string, v int", ("a", 1))
    plan = latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_normalize_types_casts_only_named_columns(table):
    df = table("a int, b string, c bigint", (1, "2", 3), (None, "x", 2**40))
    got = normalize_types(df, {"a": "double", "b": "int", "c": "int"})
    assert got.dtypes == [("a", "double"), ("b", "int"), ("c", "int")]
    assert got.collect() == [(1.0, 2, 3), (None, None, None)]
    assert normalize_types(df, {"a": "int"}).dtypes == df.dtypes


def test_conform_orders_columns(spark):
    contract = PLATINUM["customer_mart"]
    shuffled = spark.range(1).select(
        *[F.lit(1).alias(n) for n in reversed(contract.columns) if "date" not in n],
        F.lit(20180101).alias("last_purchase_date_key"),
        F.lit("2018-01-01").alias("last_purchase_date"),
    )
    assert [(f.name, f.dataType) for f in conform(shuffled, contract).schema] == [
        (f.name, f.dataType) for f in contract.schema
    ]
