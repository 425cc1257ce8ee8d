"""Retail source tables derived from the order/line-item sample tables.

The sample has orders, lines, customers, suppliers, parts and nations but no
reviews, payments or coordinates. Those are derived from its keys with integer
arithmetic, one or more rows per sample row, including the defects cleaning
has to deal with: unpadded zips, stray case and blanks, unreadable instants,
orphans, repeated reviews, scores out of range, missing categories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.lazy import Plans

# Sample prices are divided by this to fall around the spending tiers.
PRICE_SCALE = 3000


# Sample tables the retail tables derive from. Declared, so that a read needs
# no pass over file footers.
SAMPLE_DDL = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
                 o_totalprice double, o_orderdate timestamp_ntz,
                 o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint,
                   l_linenumber int, l_quantity double, l_extendedprice double,
                   l_discount double, l_tax double, l_returnflag string,
                   l_linestatus string, l_shipdate timestamp_ntz""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int,
                   c_acctbal double, c_mktsegment string""",
    "supplier": """s_suppkey bigint, s_name string, s_nationkey int,
                   s_acctbal double""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string,
               p_size int, p_retailprice double""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SAMPLE_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _plus_days(instant: str, days: str) -> str:
    return f"CAST(date_add({instant}, CAST({days} AS INT)) AS TIMESTAMP_NTZ)"


def _instant_text(instant: str) -> str:
    return f"date_format({instant}, 'yyyy-MM-dd HH:mm:ss')"


def _scaled_cents(sample_price: str) -> str:
    return f"(CAST(rint({sample_price} * 100) AS BIGINT) DIV {PRICE_SCALE})"


def _amount(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def _struct(**fields: str) -> str:
    body = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"named_struct({body})"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def when_closed(days: str) -> str:
        moment = _plus_days("o_orderdate", days)
        return f"CASE WHEN o_orderstatus <> 'O' THEN {moment} END"

    approved = _instant_text(_plus_days("o_orderdate", "1"))
    estimated = _instant_text(_plus_days("o_orderdate", "30"))
    return _table(spark, sf_dir, "orders").selectExpr(
        f"{_text('o_orderkey')} AS order_id",
        f"{_text('o_custkey')} AS customer_id",
        "o_orderstatus AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        f"""CASE WHEN o_orderkey % 97 = 5 THEN 'not recorded' ELSE {approved} END
            AS order_approved_at""",
        f"{when_closed('o_orderkey * 7 % 60 DIV 2')} AS order_delivered_carrier_date",
        f"{when_closed('o_orderkey * 7 % 60')} AS order_delivered_customer_date",
        f"{estimated} AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = _scaled_cents("l_extendedprice")
    freight = f"({price} * CAST(rint(l_tax * 100) AS BIGINT) DIV 100)"
    return _table(spark, sf_dir, "lineitem").selectExpr(
        f"{_text('l_orderkey')} AS order_id",
        "l_linenumber AS order_item_id",
        f"{_text('l_partkey')} AS product_id",
        f"{_text('l_suppkey')} AS seller_id",
        f"{_instant_text('l_shipdate')} AS shipping_limit_date",
        f"{_amount(price)} AS price",
        f"{_amount(freight)} AS freight_value",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full payments, split payments (every 5th order) and orphan payments."""
    due = _scaled_cents("o_totalprice")
    part = f"({due} * 60 DIV 100)"

    def payment(order_id: str, number: int, cents: str) -> str:
        return _struct(
            order_id=order_id,
            payment_sequential=str(number),
            payment_type="""CASE o_orderkey % 4 WHEN 0 THEN 'credit_card'
                WHEN 1 THEN 'debit_card' WHEN 2 THEN 'boleto'
                ELSE 'not_defined' END""",
            payment_installments="CAST(o_orderkey % 10 + 1 AS INT)",
            payment_value=_amount(cents),
        )

    known, unknown = _text("o_orderkey"), "concat('X', o_orderkey)"
    first = f"CASE WHEN o_orderkey % 5 = 0 THEN {part} ELSE {due} END"
    # Payments that an order does not have are rows of NULLs; array_compact is slow.
    rows = _table(spark, sf_dir, "orders").selectExpr(
        f"""inline(array(
            {payment(known, 1, first)},
            CASE WHEN o_orderkey % 5 = 0
                 THEN {payment(known, 2, f"({due} - {part})")} END,
            CASE WHEN o_orderkey % 11 = 3 THEN {payment(unknown, 1, due)} END))"""
    )
    return rows.filter("payment_sequential IS NOT NULL")


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of 3 in 4 orders, some repeated, some doubled, some orphaned."""

    def review(tag: str, score_shift: int, days_later: int) -> str:
        answered = f"o_orderkey % 20 + o_orderkey % 3 - 1 + {days_later}"
        return _struct(
            review_id=f"""CASE WHEN o_orderkey % 29 <> 0
                THEN concat('r', o_orderkey, '{tag}') END""",
            order_id=f"""CASE WHEN o_orderkey % 31 = 0 THEN concat('X', o_orderkey)
                ELSE {_text("o_orderkey")} END""",
            review_score=f"""CASE WHEN o_orderkey % 23 <> 0
                THEN CAST(1 + (o_orderkey * 13 + {score_shift}) % 7 AS INT) END""",
            review_comment_title="""CASE WHEN o_orderkey % 3 = 0
                THEN concat('title ', o_orderkey % 9) END""",
            review_comment_message="""CASE WHEN o_orderkey % 6 = 0
                THEN concat('text ', o_orderkey % 8) END""",
            review_creation_date=_instant_text(
                _plus_days("o_orderdate", "o_orderkey % 20")
            ),
            review_answer_timestamp=_instant_text(_plus_days("o_orderdate", answered)),
        )

    reviewed = _table(spark, sf_dir, "orders").filter("o_orderkey % 4 <> 0")
    return reviewed.selectExpr(
        f"""inline(array_compact(array(
            {review("", 0, 0)},
            CASE WHEN o_orderkey % 10 = 3 THEN {review("", 2, 4)} END,
            CASE WHEN o_orderkey % 12 = 5 THEN {review("b", 3, 1)} END)))"""
    )


def _nation_of(spark: SparkSession, sf_dir: str, people: str, key: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").selectExpr(f"n_nationkey AS {key}", "n_name")
    return _table(spark, sf_dir, people).join(nations, key)


_CUSTOMER_ZIP = "CAST(c_custkey * 37 % 20011 AS INT)"
_SELLER_ZIP = "CAST(s_suppkey * 53 % 20011 AS INT)"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_of(spark, sf_dir, "customer", "c_nationkey").selectExpr(
        f"{_text('c_custkey')} AS customer_id",
        "concat('u', c_custkey DIV 2) AS customer_unique_id",
        f"{_CUSTOMER_ZIP} AS customer_zip_code_prefix",
        f"concat(' City ', {_CUSTOMER_ZIP} % 300, '  ') AS customer_city",
        "concat(n_name, ' ') AS customer_state",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_of(spark, sf_dir, "supplier", "s_nationkey").selectExpr(
        f"{_text('s_suppkey')} AS seller_id",
        f"{_SELLER_ZIP} AS seller_zip_code_prefix",
        f"concat('City ', {_SELLER_ZIP} % 300) AS seller_city",
        "upper(n_name) AS seller_state",
    )


_CATEGORY = "concat_ws('_', lower(p_type), translate(lower(p_brand), '#', '_'))"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    def measured(value: str) -> str:
        return f"CASE WHEN p_partkey % 19 <> 0 THEN {value} END"

    return _table(spark, sf_dir, "part").selectExpr(
        f"{_text('p_partkey')} AS product_id",
        f"CASE WHEN p_partkey % 17 <> 0 THEN {_CATEGORY} END AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "p_size * 10 AS product_description_lenght",
        "p_size % 5 AS product_photos_qty",
        f"{measured('p_size * 250')} AS product_weight_g",
        f"{measured('p_size + 5')} AS product_length_cm",
        f"{measured('p_size % 10 + 1')} AS product_height_cm",
        f"{measured('p_size % 15 + 2')} AS product_width_cm",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English name of every category except those of one brand."""
    return (
        _table(spark, sf_dir, "part")
        .filter("p_brand <> 'Brand#7'")
        .selectExpr(f"{_CATEGORY} AS product_category_name")
        .distinct()
        .selectExpr(
            "product_category_name",
            "concat('en_', product_category_name) AS product_category_name_english",
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two points (one of them twice) around 7 in 8 customers' zips."""
    shifted = (
        _table(spark, sf_dir, "customer")
        .filter("c_custkey % 8 <> 0")
        .selectExpr("c_custkey", "explode(array(0, 1, 1)) AS i")
    )
    return shifted.selectExpr(
        f"{_CUSTOMER_ZIP} AS geolocation_zip_code_prefix",
        "CAST(-(c_custkey * 7919 % 330000 + i) AS DOUBLE) / 10000 AS geolocation_lat",
        "CAST(-(c_custkey * 10473 % 740000 + i) AS DOUBLE) / 10000 AS geolocation_lng",
        f"concat('CITY ', {_CUSTOMER_ZIP} % 300, ' ') AS geolocation_city",
        f"concat(' St', {_CUSTOMER_ZIP} % 27) AS geolocation_state",
    )


TABLES = {
    "orders": orders,
    "customers": customers,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> Plans:
    return Plans(
        {n: lambda build=build: build(spark, sf_dir) for n, build in TABLES.items()}
    )
