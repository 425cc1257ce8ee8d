"""Independent SQL for every query, for DuckDB on the same Parquet tables.

Written directly against the sample tables, layer by layer, as common table
expressions; each query carries only the ones it uses. Nothing here is shared
with the Spark code, so agreement means two formulations gave one result.
"""

from __future__ import annotations

import re


def _cents(x: str) -> str:
    return f"cast(round({x} * 100) as bigint)"


def _half_up(num: str, den: str) -> str:
    """Integer division rounded half away from zero; NULL when den is 0."""
    return f"(sign({num}) * ((2 * abs({num}) + {den}) // (2 * {den})))"


def _hundredths(num: str, den: str) -> str:
    """round(num / den, 2) of integers."""
    return f"(cast({_half_up(f'(({num}) * 100)', den)} as double) / 100)"


def _money(total_cents: str) -> str:
    return f"(cast({total_cents} as double) / 100)"


def _sum_money(x: str) -> str:
    return _money(f"sum({_cents(x)})")


def _mean_money(x: str) -> str:
    return _money(_half_up(f"sum({_cents(x)})", f"count({x})"))


def _mean_int(x: str) -> str:
    return _hundredths(f"sum({x})", f"count({x})")


def _pct(part: str, whole: str) -> str:
    return _hundredths(f"({part}) * 100", whole)


def _big(x: str) -> str:
    return f"cast({x} as bigint)"


def _key(x: str) -> str:
    return f"cast(year({x}) * 10000 + month({x}) * 100 + day({x}) as integer)"


def _stamp(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d 00:00:00')"


_D = "cast(o_orderdate as date)"
_CATEGORY = "lower(p_type) || '_' || replace(lower(p_brand), '#', '_')"
_ZIP = "(c_custkey * 37 % 20011)"
_PRICE = f"({_cents('l_extendedprice')} // 3000)"
_DUE = f"({_cents('o_totalprice')} // 3000)"
_FREIGHT = f"({_PRICE} * {_cents('l_tax')} // 100)"


def _payment(order_id: str, number: int, value: str, where: str) -> str:
    return f"""
        select {order_id} as order_id, {number} as payment_sequential,
               case o_orderkey % 4 when 0 then 'credit_card' when 1 then 'debit_card'
                    when 2 then 'boleto' else 'not_defined' end as payment_type,
               cast(o_orderkey % 10 + 1 as integer) as payment_installments,
               {_money(value)} as payment_value
        from orders where {where}"""


def _review(tag: str, score_shift: int, days_later: int, where: str) -> str:
    created = f"{_D} + cast(o_orderkey % 20 as integer)"
    answered = (
        f"{_D} + cast(o_orderkey % 20 + o_orderkey % 3 - 1 + {days_later} as integer)"
    )
    return f"""
        select case when o_orderkey % 29 <> 0
                    then 'r' || o_orderkey || '{tag}' end as review_id,
               case when o_orderkey % 31 = 0 then 'X' else '' end || o_orderkey
                 as order_id,
               case when o_orderkey % 23 <> 0
                    then cast(1 + (o_orderkey * 13 + {score_shift}) % 7 as integer) end
                 as review_score,
               case when o_orderkey % 3 = 0 then 'title ' || (o_orderkey % 9) end
                 as review_comment_title,
               case when o_orderkey % 6 = 0 then 'text ' || (o_orderkey % 8) end
                 as review_comment_message,
               {_stamp(created)} as review_creation_date,
               {_stamp(answered)} as review_answer_timestamp
        from orders where o_orderkey % 4 <> 0 and {where}"""


def _kpi(customer: str, lines: str) -> str:
    return f"""
        select total_revenue, total_orders, total_items, total_customers,
               total_sellers, total_products,
               {_money(_half_up("revenue", "total_orders"))} as avg_order_value,
               {_money(_half_up("revenue", "total_customers"))}
                 as revenue_per_customer,
               avg_delivery_time_days, avg_delivery_delay_days,
               late_delivery_rate_pct,
               {_money(f"10000 - {_cents('late_delivery_rate_pct')}")}
                 as on_time_delivery_rate_pct,
               avg_review_score, positive_review_rate_pct, total_reviews,
               repeat_customer_count,
               {_pct("repeat_customer_count", "total_customers")}
                 as repeat_customer_rate_pct
        from (select sum({_cents("total_item_value")}) as revenue,
                     {_sum_money("total_item_value")} as total_revenue,
                     count(distinct order_id) as total_orders,
                     count(order_item_id) as total_items,
                     count(distinct {customer}) as total_customers,
                     count(distinct seller_id) as total_sellers,
                     count(distinct product_id) as total_products
              from {lines}) sales,
             (select {_mean_int("shipping_duration_days")} as avg_delivery_time_days,
                     {_mean_int("delivery_delay_days")} as avg_delivery_delay_days,
                     {_pct("sum(is_late_delivery)", "count(*)")}
                       as late_delivery_rate_pct
              from fulfillment where shipping_duration_days is not null) shipping,
             (select {_mean_int("review_score")} as avg_review_score,
                     {_pct("count(*) filter (where review_score >= 4)", "count(*)")}
                       as positive_review_rate_pct,
                     count(*) as total_reviews
              from fulfillment where review_score is not null) reviews,
             (select count(*) as repeat_customer_count
              from (select {customer} from {lines} group by 1
                    having count(distinct order_id) > 1) again) repeaters"""


CTES: dict[str, str] = {
    # ---- source tables ----
    "raw_orders": f"""
        select cast(o_orderkey as varchar) as order_id,
               cast(o_custkey as varchar) as customer_id,
               o_orderstatus as order_status,
               o_orderdate as order_purchase_timestamp,
               case when o_orderkey % 97 = 5 then 'not recorded'
                    else {_stamp(_D + " + 1")} end as order_approved_at,
               case when o_orderstatus <> 'O' then cast({_D}
                    + cast((o_orderkey * 7 % 60) // 2 as integer) as timestamp) end
                 as order_delivered_carrier_date,
               case when o_orderstatus <> 'O' then cast({_D}
                    + cast(o_orderkey * 7 % 60 as integer) as timestamp) end
                 as order_delivered_customer_date,
               {_stamp(_D + " + 30")} as order_estimated_delivery_date
        from orders""",
    "raw_order_items": f"""
        select cast(l_orderkey as varchar) as order_id,
               l_linenumber as order_item_id,
               cast(l_partkey as varchar) as product_id,
               cast(l_suppkey as varchar) as seller_id,
               l_shipdate as shipping_limit_date,
               {_money(_PRICE)} as price,
               {_money(_FREIGHT)} as freight_value
        from lineitem""",
    "raw_order_payments": " union all ".join(
        [
            _payment(
                "cast(o_orderkey as varchar)",
                1,
                f"case when o_orderkey % 5 = 0 then {_DUE} * 60 // 100 else {_DUE} end",
                "true",
            ),
            _payment(
                "cast(o_orderkey as varchar)",
                2,
                f"{_DUE} - {_DUE} * 60 // 100",
                "o_orderkey % 5 = 0",
            ),
            _payment("'X' || o_orderkey", 1, _DUE, "o_orderkey % 11 = 3"),
        ]
    ),
    "raw_order_reviews": " union all ".join(
        [
            _review("", 0, 0, "true"),
            _review("", 2, 4, "o_orderkey % 10 = 3"),
            _review("b", 3, 1, "o_orderkey % 12 = 5"),
        ]
    ),
    "raw_customers": f"""
        select cast(c_custkey as varchar) as customer_id,
               'u' || (c_custkey // 2) as customer_unique_id,
               {_ZIP} as customer_zip_code_prefix,
               ' City ' || ({_ZIP} % 300) || '  ' as customer_city,
               n_name || ' ' as customer_state
        from customer join nation on c_nationkey = n_nationkey""",
    "raw_sellers": """
        select cast(s_suppkey as varchar) as seller_id,
               s_suppkey * 53 % 20011 as seller_zip_code_prefix,
               'City ' || ((s_suppkey * 53 % 20011) % 300) as seller_city,
               upper(n_name) as seller_state
        from supplier join nation on s_nationkey = n_nationkey""",
    "raw_products": f"""
        select cast(p_partkey as varchar) as product_id,
               case when p_partkey % 17 <> 0 then {_CATEGORY} end
                 as product_category_name,
               cast(length(p_name) as integer) as product_name_lenght,
               p_size * 10 as product_description_lenght,
               p_size % 5 as product_photos_qty,
               case when p_partkey % 19 <> 0 then p_size * 250 end as product_weight_g,
               case when p_partkey % 19 <> 0 then p_size + 5 end as product_length_cm,
               case when p_partkey % 19 <> 0 then p_size % 10 + 1 end
                 as product_height_cm,
               case when p_partkey % 19 <> 0 then p_size % 15 + 2 end
                 as product_width_cm
        from part""",
    "raw_category_translation": f"""
        select distinct {_CATEGORY} as product_category_name,
               'en_' || {_CATEGORY} as product_category_name_english
        from part where p_brand <> 'Brand#7'""",
    "raw_geolocation": f"""
        select {_ZIP} as geolocation_zip_code_prefix,
               cast(-(c_custkey * 7919 % 330000 + i) as double) / 10000
                 as geolocation_lat,
               cast(-(c_custkey * 10473 % 740000 + i) as double) / 10000
                 as geolocation_lng,
               'CITY ' || ({_ZIP} % 300) || ' ' as geolocation_city,
               ' St' || ({_ZIP} % 27) as geolocation_state
        from (select *, unnest([0, 1, 1]) as i from customer) shifted
        where c_custkey % 8 <> 0""",
    # ---- clean tables ----
    "orders_c": """
        select order_id, customer_id, order_status, order_purchase_timestamp,
               try_cast(order_approved_at as timestamp) as order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date,
               try_cast(order_estimated_delivery_date as timestamp)
                 as order_estimated_delivery_date
        from raw_orders""",
    "items_c": "select * from raw_order_items",
    "payments_c": """
        select order_id, payment_sequential,
               case payment_type when 'credit_card' then 'credit card'
                    when 'debit_card' then 'debit card'
                    when 'not_defined' then 'not defined'
                    else payment_type end as payment_type,
               payment_installments, payment_value
        from raw_order_payments
        where order_id in (select order_id from orders_c)""",
    "reviews_c": """
        select review_id, order_id, review_score,
               coalesce(review_comment_title, 'No Title') as review_comment_title,
               coalesce(review_comment_message, 'No Message')
                 as review_comment_message,
               cast(review_creation_date as timestamp) as review_creation_date,
               cast(review_answer_timestamp as timestamp) as review_answer_timestamp
        from (select *, row_number() over (
                       partition by review_id
                       order by review_answer_timestamp desc nulls last,
                                order_id desc nulls last,
                                review_score desc nulls last,
                                review_comment_title desc nulls last,
                                review_comment_message desc nulls last,
                                review_creation_date desc nulls last) as place
              from raw_order_reviews
              where review_id is not null and order_id is not null) ranked
        where place = 1 and (review_score is null or review_score between 1 and 5)
          and order_id in (select order_id from orders_c)""",
    "customers_c": """
        select customer_id, customer_unique_id,
               lpad(cast(customer_zip_code_prefix as varchar), 5, '0')
                 as customer_zip_code_prefix,
               lower(trim(customer_city)) as customer_city,
               lower(trim(customer_state)) as customer_state
        from raw_customers""",
    "sellers_c": """
        select seller_id,
               lpad(cast(seller_zip_code_prefix as varchar), 5, '0')
                 as seller_zip_code_prefix,
               lower(trim(seller_city)) as seller_city,
               lower(trim(seller_state)) as seller_state
        from raw_sellers""",
    "geo_tidy": """
        select lpad(cast(geolocation_zip_code_prefix as varchar), 5, '0')
                 as geolocation_zip_code_prefix,
               geolocation_lat, geolocation_lng,
               lower(trim(geolocation_city)) as geolocation_city,
               lower(trim(geolocation_state)) as geolocation_state
        from raw_geolocation""",
    "geo_c": """
        select geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
               max(geolocation_city) as geolocation_city,
               max(geolocation_state) as geolocation_state
        from geo_tidy group by 1, 2, 3""",
    "translation_c": """
        select replace(product_category_name, '_', ' ') as product_category_name,
               replace(product_category_name_english, '_', ' ')
                 as product_category_name_english
        from raw_category_translation""",
    "products_named": """
        select * replace (replace(coalesce(product_category_name, 'unknown'), '_', ' ')
                          as product_category_name)
        from raw_products""",
    "products_c": """
        select p.*, coalesce(t.product_category_name_english, 'unknown')
                 as product_category_name_english
        from products_named p left join translation_c t using (product_category_name)""",
    # ---- star schema ----
    "centroid": """
        select geolocation_zip_code_prefix,
               cast(sum(cast(round(geolocation_lat * 10000) as bigint)) as double)
                 / 10000 / count(*) as geolocation_lat,
               cast(sum(cast(round(geolocation_lng * 10000) as bigint)) as double)
                 / 10000 / count(*) as geolocation_lng
        from geo_c group by 1""",
    "dim_customers": """
        select customer_id, customer_unique_id, customer_city, customer_state,
               customer_zip_code_prefix, geolocation_lat as customer_lat,
               geolocation_lng as customer_lng
        from customers_c left join centroid
          on customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "dim_sellers": """
        select seller_id, seller_city, seller_state, seller_zip_code_prefix,
               geolocation_lat as seller_lat, geolocation_lng as seller_lng
        from sellers_c left join centroid
          on seller_zip_code_prefix = geolocation_zip_code_prefix""",
    "dim_products": """
        select product_id, p.product_category_name as product_category_pt,
               t.product_category_name_english as product_category_en,
               cast(product_weight_g as double) as product_weight_g,
               cast(product_length_cm as double) as product_length_cm,
               cast(product_height_cm as double) as product_height_cm,
               cast(product_width_cm as double) as product_width_cm
        from products_named p left join translation_c t using (product_category_name)""",
    "dim_date": f"""
        select {_key("full_date")} as date_key, full_date,
               cast(day(full_date) as integer) as day_of_month,
               cast(dayofweek(full_date) + 1 as integer) as day_of_week,
               dayname(full_date) as day_name,
               cast(month(full_date) as integer) as month,
               cast(quarter(full_date) as integer) as quarter,
               cast(year(full_date) as integer) as year,
               dayofweek(full_date) in (0, 6) as is_weekend
        from (select cast(unnest(generate_series(
                       make_date(year(min(order_purchase_timestamp)), 1, 1),
                       make_date(year(max(order_purchase_timestamp)), 12, 31),
                       interval 1 day)) as date) as full_date
              from orders_c) days""",
    "fact_sales": f"""
        select i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
               o.order_status,
               {_key("o.order_purchase_timestamp")} as purchase_date_key,
               i.price, i.freight_value,
               {_money(f"{_cents('i.price')} + {_cents('i.freight_value')}")}
                 as total_item_value,
               p.total_payment_value
        from items_c i join orders_c o using (order_id)
        left join (select order_id, {_sum_money("payment_value")}
                            as total_payment_value
                   from payments_c group by 1) p using (order_id)""",
    "fulfillment": f"""
        select o.order_id, o.customer_id, r.review_id, o.order_status, r.review_score,
               {_key("o.order_purchase_timestamp")} as purchase_date_key,
               {_key("o.order_estimated_delivery_date")} as estimated_delivery_date_key,
               {_key("o.order_delivered_customer_date")} as actual_delivery_date_key,
               cast(date_diff('day', o.order_estimated_delivery_date,
                              o.order_delivered_customer_date) as integer)
                 as delivery_delay_days,
               cast(date_diff('day', o.order_purchase_timestamp,
                              o.order_delivered_customer_date) as integer)
                 as shipping_duration_days,
               case when date_diff('day', o.order_estimated_delivery_date,
                                   o.order_delivered_customer_date) > 0
                    then 1 else 0 end as is_late_delivery
        from orders_c o left join reviews_c r using (order_id)""",
    # ---- marts ----
    "sales_mart": f"""
        select purchase_date_key, full_date, year, month, quarter, day_of_week,
               day_name, is_weekend, total_revenue, total_payment, total_orders,
               total_items, avg_order_value, avg_item_price, total_freight,
               case when prev <> 0 then
                 {_hundredths(f"({_cents('total_revenue')} - prev) * 100", "prev")}
               end as revenue_day_growth_pct
        from (select *, lag({_cents("total_revenue")})
                          over (order by purchase_date_key) as prev
              from (select purchase_date_key,
                           {_sum_money("total_item_value")} as total_revenue,
                           {_sum_money("total_payment_value")} as total_payment,
                           count(distinct order_id) as total_orders,
                           count(order_item_id) as total_items,
                           {_money(_half_up(f"sum({_cents('total_item_value')})",
                                            "count(distinct order_id)"))}
                             as avg_order_value,
                           {_mean_money("price")} as avg_item_price,
                           {_sum_money("freight_value")} as total_freight
                    from fact_sales group by 1) daily
              join dim_date on purchase_date_key = date_key) dated""",
    "customer_mart": f"""
        select customer_id, customer_unique_id, customer_city, customer_state,
               customer_zip_code_prefix, total_orders, total_spent, avg_order_value,
               total_items_purchased, total_freight_paid, avg_item_price,
               last_purchase_date_key, full_date as last_purchase_date,
               case when total_orders > 1 then 1 else 0 end as is_repeat_customer
        from (select customer_id, count(distinct order_id) as total_orders,
                     {_sum_money("total_item_value")} as total_spent,
                     {_money(_half_up(f"sum({_cents('total_item_value')})",
                                      "count(distinct order_id)"))} as avg_order_value,
                     count(order_item_id) as total_items_purchased,
                     {_sum_money("freight_value")} as total_freight_paid,
                     {_mean_money("price")} as avg_item_price,
                     max(purchase_date_key) as last_purchase_date_key
              from fact_sales group by 1) spent
        join dim_customers using (customer_id)
        left join dim_date on last_purchase_date_key = date_key""",
    "product_mart": f"""
        select product_id, product_category_en as category, total_sales,
               total_quantity, total_orders, avg_price, avg_freight, total_freight,
               product_weight_g, product_length_cm, product_height_cm,
               product_width_cm
        from (select product_id, {_sum_money("total_item_value")} as total_sales,
                     count(order_item_id) as total_quantity,
                     count(distinct order_id) as total_orders,
                     {_mean_money("price")} as avg_price,
                     {_mean_money("freight_value")} as avg_freight,
                     {_sum_money("freight_value")} as total_freight
              from fact_sales group by 1) sold
        join dim_products using (product_id)""",
    "kpi": _kpi("customer_id", "fact_sales"),
    # ---- upsert inputs ----
    "known_customers": """
        select * from customers_c where cast(customer_id as bigint) % 10 <> 0""",
    "changed_customers": """
        select * replace ('new ' || customer_city as customer_city)
        from customers_c
        where cast(customer_id as bigint) % 10 = 0
           or cast(customer_id as bigint) % 7 = 0""",
    "upserted_customers": """
        select * from known_customers
        where customer_id not in (select customer_id from changed_customers)
        union all select * from changed_customers""",
}

_WORD = re.compile(r"[a-z_]+")


def with_ctes(body: str, other: dict[str, str] | None = None) -> str:
    """``body`` with the common table expressions it needs, in order; ``other`` replaces some."""
    tables = {**CTES, **(other or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(text):
            if word in tables and word not in needed:
                visit(tables[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    heads = ", ".join(f"{name} as ({tables[name]})" for name in needed)
    return f"with {heads} {body}" if needed else body


def _edited(table: str, **columns: str) -> str:
    new = ", ".join(f"{value} as {name}" for name, value in columns.items())
    return f"select * replace ({new}) from ({CTES[table]}) as unedited"


def _where(divisor: int, rest: int, value: str, column: str) -> str:
    return f"""case when cast(order_id as bigint) % {divisor} = {rest} then {value}
                    else {column} end"""


# The clean tables after their changes.
_CHANGED = {
    "orders_c": _edited(
        "orders_c",
        customer_id=_where(39, 2, "'1'", "customer_id"),
        order_purchase_timestamp=_where(
            13, 2, "order_purchase_timestamp + interval 3 day", "order_purchase_timestamp"
        ),
    ),
    "items_c": _edited(
        "items_c",
        price=_where(17, 5, "price + 1.5", "price"),
        product_id=_where(17, 5, "case when order_item_id = 1 then '7' else product_id end", "product_id"),
    ),
    "payments_c": _edited(
        "payments_c", payment_value=_where(19, 3, "payment_value + 2.25", "payment_value")
    ),
    "reviews_c": _edited("reviews_c", review_score=_where(23, 4, "5", "review_score")),
}


def _tier(value: str, steps: list[tuple[int, str]], rest: str) -> str:
    whens = " ".join(f"when {value} >= {n} then '{label}'" for n, label in steps)
    return f"case {whens} else '{rest}' end"


_SPENDING = _tier(
    "total_spent",
    [(1000, "High (1000+)"), (500, "Medium (500-999)"), (100, "Low (100-499)")],
    "Minimal (<100)",
)
_WEIGHT = _tier(
    "product_weight_g",
    [(10000, "Heavy (10kg+)"), (5000, "Medium (5-10kg)"), (1000, "Light (1-5kg)")],
    "Very Light (<1kg)",
)

_DAY_TYPE = "case when is_weekend then 'Weekend' else 'Weekday' end"

_MONTHLY = f"""
    select year, month, {_sum_money("total_revenue")} as monthly_revenue,
           {_sum_money("total_payment")} as monthly_payment,
           {_big("sum(total_orders)")} as monthly_orders,
           {_big("sum(total_items)")} as monthly_items,
           {_sum_money("total_freight")} as monthly_freight,
           {_money(_half_up(f"sum({_cents('total_revenue')})", "sum(total_orders)"))}
             as avg_order_value
    from sales_mart group by year, month"""

_BY_CATEGORY = f"""
    select category, count(*) as product_count,
           {_sum_money("total_sales")} as total_revenue,
           {_big("sum(total_quantity)")} as total_items,
           {_big("sum(total_orders)")} as total_orders,
           {_mean_money("avg_price")} as avg_price,
           {_mean_money("avg_freight")} as avg_freight,
           {_sum_money("total_freight")} as total_freight
    from product_mart group by category"""

_BY_STATE = f"""
    select customer_state, count(*) as customer_count,
           {_sum_money("total_spent")} as total_revenue,
           {_mean_money("total_spent")} as avg_customer_value,
           {_big("sum(total_orders)")} as total_orders,
           count(*) filter (where is_repeat_customer = 1) as repeat_customers,
           {_pct("count(*) filter (where is_repeat_customer = 1)", "count(*)")}
             as repeat_rate_pct
    from customer_mart group by customer_state"""

_TIERS = f"""
    select {_SPENDING} as spending_tier, count(*) as customer_count,
           {_sum_money("total_spent")} as total_revenue,
           {_mean_int("total_orders")} as avg_orders,
           {_mean_int("total_items_purchased")} as avg_items
    from customer_mart group by 1"""


def _weekend(extra: str) -> str:
    return f"""
    select {_DAY_TYPE} as day_type, count(*) as num_days,
           {_sum_money("total_revenue")} as total_revenue,
           {_mean_money("total_revenue")} as avg_daily_revenue,
           {_big("sum(total_orders)")} as total_orders,
           {_mean_int("total_orders")} as avg_daily_orders{extra}
    from sales_mart group by 1"""


def _delivery(by: str, source: str) -> str:
    return f"""
    select {by}, count(*) as deliveries,
           {_mean_int("shipping_duration_days")} as avg_shipping_days,
           {_mean_int("delivery_delay_days")} as avg_delay_days,
           {_pct("sum(is_late_delivery)", "count(*)")} as late_rate_pct,
           {_pct("count(*) - sum(is_late_delivery)", "count(*)")} as on_time_rate_pct
    from {source} where shipping_duration_days is not null group by all"""


_MONTH_OF_KEY = """cast(purchase_date_key // 10000 as integer) as year,
           cast(purchase_date_key // 100 % 100 as integer) as month"""


def _counts(**tables: str) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {source}"
        for name, source in tables.items()
    )


_CLEAN = {
    "orders": "orders_c",
    "customers": "customers_c",
    "order_items": "items_c",
    "order_payments": "payments_c",
    "order_reviews": "reviews_c",
    "products": "products_c",
    "sellers": "sellers_c",
    "geolocation": "geo_c",
    "category_translation": "translation_c",
}
_STAR = {
    "dim_products": "dim_products",
    "dim_sellers": "dim_sellers",
    "dim_customers": "dim_customers",
    "dim_date": "dim_date",
    "fact_sales": "fact_sales",
    "fact_order_fulfillment": "fulfillment",
}
_MARTS = {
    "sales_summary_mart": "sales_mart",
    "customer_mart": "customer_mart",
    "product_mart": "product_mart",
    "kpi_summary": "kpi",
}


def _profile(table: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"""select '{name}' as column_name, '{dtype}' as data_type,
                   count({name}) as non_null, count(*) - count({name}) as nulls,
                   count(*) as row_count
            from {table}"""
        for name, dtype in columns.items()
    )


def _as_text(value: str, kind: str) -> str:
    return value if kind == "string" else f"cast(cast({value} as double) as varchar)"


def _negatives(table: str, *columns: str) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} < 0) as negatives "
        f"from {table}"
        for c in columns
    )


def _concentration(by: str) -> str:
    return f"""
    select {by}, customer_count, {_money("cents")} as total_revenue,
           {_pct("customer_count", "sum(customer_count) over ()")}
             as customer_share_pct,
           {_pct("cents", "sum(cents) over ()")} as revenue_share_pct,
           {_pct("sum(cents) over (order by cents desc)", "sum(cents) over ()")}
             as cumulative_revenue_pct,
           rank() over (order by cents desc) as revenue_rank
    from (select {by}, count(*) as customer_count,
                 sum({_cents("total_spent")}) as cents
          from customer_mart group by all) places"""


def _quintile(value: str) -> str:
    return (
        f"cast(5 * (rank() over (order by {value}) - 1) // count(*) over () + 1 "
        "as integer)"
    )


# Orders whose approval time is no time: loaded, with their raw lines kept.
_REJECTED = {
    "orders": """count_if(order_approved_at = 'not recorded')
                 || ' raw rows kept as rejects'"""
}

_RFM = f"""
    select customer_unique_id, recency_days, frequency, monetary,
           r_score, f_score, m_score,
           case when r_score >= 4 and f_score >= 4 and m_score >= 4 then 'VIP'
                when r_score >= 4 and frequency = 1 then 'New'
                when r_score <= 2 and (f_score >= 3 or m_score >= 3) then 'At risk'
                else 'Regular' end as segment
    from (select customer_unique_id, recency_days, frequency,
                 {_money("cents")} as monetary,
                 6 - {_quintile("recency_days")} as r_score,
                 {_quintile("frequency")} as f_score,
                 {_quintile("cents")} as m_score
          from (select customer_unique_id,
                       cast(date_diff('day', max(last_purchase_date),
                            max(max(last_purchase_date)) over ()) as integer)
                         as recency_days,
                       {_big("sum(total_orders)")} as frequency,
                       sum({_cents("total_spent")}) as cents
                from customer_mart group by 1) people) scored"""

BODIES: dict[str, str] = {
    **{f"clean_{name}": f"select * from {cte}" for name, cte in _CLEAN.items()},
    **{name: f"select * from {cte}" for name, cte in _STAR.items()},
    **{name: f"select * from {cte}" for name, cte in _MARTS.items()},
    "clean_geolocation_lookup": """
        select * exclude (place)
        from (select *, row_number() over (
                       partition by geolocation_zip_code_prefix
                       order by geolocation_lat desc, geolocation_lng desc,
                                geolocation_city desc, geolocation_state desc)
                         as place
              from geo_tidy) ranked where place = 1""",
    "geo_centroid": "select * from centroid",
    "sales_summary_payments_once": f"""
        select m.purchase_date_key, m.total_payment,
               {_money("once.paid")} as total_payment_orders
        from sales_mart m
        join (select purchase_date_key, sum(paid) as paid
              from (select purchase_date_key, order_id,
                           max({_cents("total_payment_value")}) as paid
                    from fact_sales group by 1, 2) per_order
              group by 1) once using (purchase_date_key)""",
    "sales_summary_densified": f"""
        select m.* replace (case when y.total_revenue <> 0 then
                 {_hundredths(
                     f"({_cents('m.total_revenue')} - {_cents('y.total_revenue')}) * 100",
                     _cents("y.total_revenue"))}
               end as revenue_day_growth_pct)
        from sales_mart m left join sales_mart y on y.full_date + 1 = m.full_date""",
    "kpi_summary_by_person": _kpi(
        "customer_unique_id", "fact_sales left join dim_customers using (customer_id)"
    ),
    "period_growth": f"""
        select order_status, period, {_money("cents")} as revenue,
               case when prev <> 0 then {_hundredths("(cents - prev) * 100", "prev")}
               end as growth_pct
        from (select *, lag(cents) over (partition by order_status order by period)
                          as prev
              from (select order_status,
                           cast(purchase_date_key // 100 as integer) as period,
                           sum({_cents("total_item_value")}) as cents
                    from fact_sales group by 1, 2) monthly) lagged""",
    "normalize_schema": """
        select * replace (cast(product_weight_g as double) as product_weight_g,
                          cast(product_length_cm as double) as product_length_cm,
                          cast(product_height_cm as double) as product_height_cm,
                          cast(product_width_cm as double) as product_width_cm)
        from raw_products""",
    # ---- reports ----
    "q01_row_counts": _counts(**_MARTS),
    "q02_preview_sales_summary_mart": """
        select * from sales_mart order by purchase_date_key limit 10""",
    "q02_preview_customer_mart": """
        select * from customer_mart order by customer_id limit 10""",
    "q02_preview_product_mart": """
        select * from product_mart order by product_id limit 10""",
    "q02_preview_kpi_summary": "select * from kpi limit 10",
    "q03_headline_kpis": "select * from kpi",
    "q04_daily_trend": """
        select purchase_date_key, full_date, day_name, is_weekend, total_revenue,
               total_payment, total_orders, total_items, avg_order_value,
               avg_item_price, total_freight, revenue_day_growth_pct
        from sales_mart order by purchase_date_key desc limit 30""",
    "q05_monthly_revenue": _MONTHLY,
    "q06_quarterly_revenue": f"""
        select year, quarter, {_sum_money("total_revenue")} as quarterly_revenue,
               {_big("sum(total_orders)")} as quarterly_orders,
               {_big("sum(total_items)")} as quarterly_items
        from sales_mart group by year, quarter""",
    "q07_weekend_vs_weekday": _weekend(
        f", {_mean_money('avg_item_price')} as avg_item_price"
    ),
    "q08_revenue_by_weekday": f"""
        select day_name, day_of_week, {_sum_money("total_revenue")} as total_revenue,
               {_mean_money("total_revenue")} as avg_daily_revenue,
               {_big("sum(total_orders)")} as total_orders
        from sales_mart group by 1, 2""",
    "q09_top_revenue_days": """
        select purchase_date_key, full_date, day_name, total_revenue, total_orders,
               avg_order_value
        from sales_mart order by total_revenue desc, purchase_date_key limit 10""",
    "q10_top_growth_days": """
        select purchase_date_key, full_date, total_revenue, revenue_day_growth_pct
        from sales_mart where revenue_day_growth_pct is not null
        order by revenue_day_growth_pct desc, purchase_date_key limit 10""",
    "q11_top_customers": """
        select customer_id, customer_unique_id, customer_city, customer_state,
               total_orders, total_spent, avg_order_value, total_items_purchased,
               total_freight_paid, avg_item_price, last_purchase_date,
               is_repeat_customer
        from customer_mart order by total_spent desc, customer_id limit 20""",
    "q12_customers_by_state": _BY_STATE,
    "q13_repeat_vs_one_time": f"""
        select case when is_repeat_customer = 1 then 'Repeat' else 'One-time' end
                 as customer_type,
               count(*) as customer_count,
               {_sum_money("total_spent")} as total_revenue,
               {_mean_money("total_spent")} as avg_spending,
               {_mean_int("total_orders")} as avg_orders,
               {_mean_money("avg_item_price")} as avg_item_price
        from customer_mart group by 1""",
    "q14_spending_tiers": _TIERS,
    "q15_top_cities": f"""
        select customer_city, customer_state, count(*) as customer_count,
               {_sum_money("total_spent")} as total_revenue,
               {_mean_money("total_spent")} as avg_customer_value
        from customer_mart group by 1, 2
        order by total_revenue desc, customer_city, customer_state limit 10""",
    "q16_top_products": """
        select product_id, category, total_sales, total_quantity, total_orders,
               avg_price, avg_freight, total_freight
        from product_mart order by total_sales desc, product_id limit 20""",
    "q17_sales_by_category": _BY_CATEGORY,
    "q18_top_categories": f"""
        select category, {_sum_money("total_sales")} as total_revenue,
               {_big("sum(total_quantity)")} as total_items, count(*) as product_count
        from product_mart group by category
        order by total_revenue desc, category nulls last limit 10""",
    "q19_weight_vs_freight": f"""
        select {_WEIGHT} as weight_tier, count(*) as product_count,
               {_mean_money("avg_freight")} as avg_freight,
               {_mean_money("avg_price")} as avg_price,
               {_sum_money("total_sales")} as total_revenue,
               {_sum_money("total_freight")} as total_freight
        from product_mart where product_weight_g is not null group by 1""",
    "q20_product_volumes": """
        select product_id, category, total_sales, avg_price, product_weight_g,
               product_length_cm * product_height_cm * product_width_cm as volume_cm3,
               avg_freight
        from product_mart
        where product_length_cm is not null and product_height_cm is not null
          and product_width_cm is not null
        order by total_sales desc, product_id limit 20""",
    "q21_top_states": f"""
        select customer_state, count(*) as customer_count,
               {_sum_money("total_spent")} as total_customer_revenue,
               {_mean_money("total_spent")} as avg_customer_value,
               {_big("sum(total_orders)")} as total_orders
        from customer_mart group by 1
        order by total_customer_revenue desc, customer_state limit 10""",
    "q22_category_performance": f"""
        select category, count(*) as product_count,
               {_sum_money("total_sales")} as category_revenue,
               {_big("sum(total_quantity)")} as total_items_sold,
               {_mean_money("avg_price")} as avg_product_price,
               {_mean_int("cast(product_weight_g as bigint)")} as avg_weight_g,
               {_sum_money("total_freight")} as total_freight_cost
        from product_mart group by category
        order by category_revenue desc, category nulls last limit 15""",
    "vw_monthly_sales": _MONTHLY,
    "vw_category_performance": _BY_CATEGORY,
    "vw_customer_state_summary": _BY_STATE,
    "vw_customer_tiers": _TIERS,
    "vw_weekday_weekend": _weekend(""),
    # ---- quality ----
    "profile_columns": _profile(
        "raw_order_reviews",
        {
            "review_id": "string",
            "order_id": "string",
            "review_score": "int",
            "review_comment_title": "string",
            "review_comment_message": "string",
            "review_creation_date": "string",
            "review_answer_timestamp": "string",
        },
    ),
    "null_counts": f"""
        select {", ".join(f"count(*) - count({c}) as {c}" for c in (
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"))}
        from orders_c""",
    "negative_counts": " union all ".join(
        [
            _negatives("raw_geolocation", "geolocation_lat", "geolocation_lng"),
            _negatives(
                "raw_order_payments",
                "payment_sequential",
                "payment_installments",
                "payment_value",
            ),
        ]
    ),
    "duplicate_keys": """
        select order_id, order_item_id, count(*) as row_count from raw_order_items
        group by 1, 2 having count(*) > 1""",
    "orphan_payments": """
        select * from raw_order_payments p
        where not exists (select 1 from raw_orders o where o.order_id = p.order_id)""",
    "orphan_customer_zips": """
        select * from customers_c where customer_zip_code_prefix not in
          (select geolocation_zip_code_prefix from geo_c)""",
    "temporal_violations": """
        select * from reviews_c
        where cast(review_creation_date as date)
            > cast(review_answer_timestamp as date)""",
    "value_frequency": """
        select payment_type, count(*) as row_count from payments_c group by 1""",
    "distinct_values": "select distinct customer_city from customers_c",
    "matching_cities": """
        select * from customers_c where customer_city like 'city 1%'""",
    "zip_ranges": """
        select case when customer_zip_code_prefix is null then 'missing'
                    when customer_zip_code_prefix > 99999 then 'wrong length'
                    when customer_zip_code_prefix < 10000 then 'leading zero'
                    else 'plain' end as zip_shape,
               count(*) as row_count
        from raw_customers group by 1""",
    "reconcile_payments": """
        select * from fact_sales where total_item_value <> total_payment_value""",
    "row_count_report": _counts(**_CLEAN, **_STAR),
    "validate_counts": f"""
        select table_name, r.row_count as expected_count, c.row_count,
               case when r.row_count = c.row_count then 'PASS' else 'FAIL' end
                 as status
        from ({_counts(**{t: f"raw_{t}" for t in _CLEAN})}) r
        join ({_counts(**_CLEAN)}) c using (table_name)""",
    # ---- upsert, loads, layout, catalog ----
    "upsert_by_key": "select * from upserted_customers",
    "upsert_partitions": f"""
        select order_id, customer_id,
               case when cast(order_id as bigint) % 2 = 0 then 'closed'
                    else order_status end as order_status,
               day, year, month
        from (select order_id, customer_id, order_status,
                     {_key("order_purchase_timestamp")} as day,
                     cast(year(order_purchase_timestamp) as integer) as year,
                     cast(month(order_purchase_timestamp) as integer) as month
              from orders_c) o
        where year = (select year(max(order_purchase_timestamp)) from orders_c)
          and month in (select month(order_purchase_timestamp) from orders_c
                        where year(order_purchase_timestamp) = o.year
                          and cast(order_id as bigint) % 2 = 0)""",
    "csv_full_load": " union all ".join(
        f"""select '{t}' as table_name, 'LOADED' as status, count(*) as new_rows,
                   count(*) as total_rows, {_REJECTED.get(t, "cast(null as varchar)")}
                     as error
            from raw_{t}"""
        for t in _CLEAN
    ),
    "csv_scan": """
        select * replace ('said "yes",' || chr(10) || 'then '
                          || review_comment_message as review_comment_message)
        from reviews_c""",
    "csv_records_scan": """
        select * replace ('said "yes",' || chr(10) || 'then '
                          || review_comment_message as review_comment_message)
        from reviews_c""",
    "csv_incremental_load": "select * from upserted_customers",
    "stream_upsert": "select * from upserted_customers",
    "stream_daily_mart": "select * from sales_mart",
    "partitioned_fact_sales": """
        select *, cast(purchase_date_key // 10000 as integer) as year,
               cast(purchase_date_key // 100 % 100 as integer) as month
        from fact_sales where purchase_date_key // 10000 = 1997""",
    "catalog_view": _TIERS,
    "csv_incremental_partitioned": "select * from upserted_customers",
    "replace_table": "select * from sellers_c where cast(seller_id as bigint) % 2 = 0",
    "table_existence": f"""
        select table_name, cast(null as bigint) as expected_count, row_count,
               case when row_count is null then 'MISSING' else 'EXISTS' end as status
        from (values {", ".join(f"('{t}')" for t in _CLEAN)}) names(table_name)
        left join ({_counts(sellers="sellers_c", orders="orders_c")}) written
          using (table_name)""",
    "clustered_fact_scan": """
        (select 'product_id' as column_name, product_id as value, count(*) as lines,
                true as under_a_third
         from fact_sales group by product_id order by product_id limit 20)
        union all
        (select 'purchase_date_key', cast(purchase_date_key as varchar), count(*), true
         from fact_sales group by purchase_date_key order by purchase_date_key limit 20)""",
    "price_as_of_purchase": """
        select l.order_id, l.order_item_id, l.product_id, l.purchase_date_key, l.price,
               h.listed_price, h.listed_day
        from (select *, cast(date_diff('day', date '1990-01-01',
                     strptime(cast(purchase_date_key as varchar), '%Y%m%d'))
                   as integer) as day from fact_sales) l
        asof left join (
          select product_id, max(price) as listed_price,
                 cast(date_diff('day', date '1990-01-01',
                      strptime(cast(purchase_date_key as varchar), '%Y%m%d'))
                   as integer) as listed_day
          from fact_sales group by product_id, purchase_date_key) h
        on l.product_id = h.product_id and l.day > h.listed_day""",
    "layer_difference": """
        select order_id, case when k % 101 = 3 then 'missing' else 'changed' end as status
        from (select order_id, order_status, cast(order_id as bigint) as k from orders_c) o
        where k % 101 = 3 or k % 97 = 5
        union all
        select order_id || 'Z', 'extra' from orders_c
        where cast(order_id as bigint) % 103 = 7""",
    # ---- mergeable states: exact at the sample's size ----
    "distinct_customers_by_period": """
        select case when grouping(year) = 1 then 'all'
                    when grouping(quarter) = 1 then 'year'
                    when grouping(month) = 1 then 'quarter'
                    else 'month' end as level,
               year, quarter, month, count(distinct customer_id) as customers
        from (select customer_id, cast(k // 10000 as integer) as year,
                     cast((k // 100 % 100 + 2) // 3 as integer) as quarter,
                     cast(k // 100 % 100 as integer) as month
              from (select customer_id, purchase_date_key as k from fact_sales
                    where purchase_date_key is not null) dated) periods
        group by rollup (year, quarter, month)""",
    "customer_flow_by_month": """
        select cast(m // 12 as integer) as year, cast(m % 12 + 1 as integer) as month,
               count(*) as customers,
               count(*) filter (where last = m - 1) as returning_customers,
               count(*) filter (where last is null) as new_customers
        from (select m, lag(m) over (partition by customer_id order by m) as last
              from (select distinct customer_id,
                           purchase_date_key // 10000 * 12
                             + purchase_date_key // 100 % 100 - 1 as m
                    from fact_sales where purchase_date_key is not null) months) seen
        group by m""",
    "delivery_percentiles_by_state": """
        select customer_state, max(n) as deliveries,
               min(d) filter (where 100 * place >= 50 * n) as p50,
               min(d) filter (where 100 * place >= 90 * n) as p90,
               min(d) filter (where 100 * place >= 99 * n) as p99
        from (select customer_state, shipping_duration_days as d,
                     row_number() over (partition by customer_state
                                        order by shipping_duration_days) as place,
                     count(*) over (partition by customer_state) as n
              from fulfillment join dim_customers using (customer_id)
              where shipping_duration_days is not null) placed
        group by customer_state""",
    "delivery_sketch_check": """
        select customer_state, count(*) as deliveries, true as p50_holds,
               true as p90_holds, true as p99_holds
        from fulfillment join dim_customers using (customer_id)
        where shipping_duration_days is not null group by customer_state""",
    "profile_states": " union all ".join(
        f"""select '{name}' as column_name, '{kind}' as data_type,
                   count(*) as row_count, count(*) - count({name}) as nulls,
                   count(distinct {name}) as distinct_values,
                   {_as_text(f"min({name})", kind)} as least,
                   {_as_text(f"max({name})", kind)} as largest,
                   (select cast({name} as varchar) from payments_c where {name} is not null
                    group by {name} order by count(*) desc, cast({name} as varchar) limit 1)
                     as top,
                   (select count(*) from payments_c where {name} is not null
                    group by {name} order by count(*) desc limit 1) as top_rows
            from payments_c"""
        for name, kind in (
            ("payment_type", "string"),
            ("payment_installments", "int"),
            ("payment_sequential", "int"),
        )
    ),
    # ---- insights ----
    "revenue_by_period": f"""
        select case when grouping(year) = 1 then 'all'
                    when grouping(quarter) = 1 then 'year'
                    when grouping(month) = 1 then 'quarter'
                    else 'month' end as level,
               year, quarter, month, {_sum_money("total_revenue")} as total_revenue,
               {_big("sum(total_orders)")} as total_orders
        from sales_mart group by rollup (year, quarter, month)""",
    "revenue_by_geography": f"""
        select case when grouping(customer_state) = 1 then 'all'
                    when grouping(customer_city) = 1 then 'state'
                    else 'city' end as level,
               customer_state, customer_city, count(*) as customer_count,
               {_sum_money("total_spent")} as total_revenue,
               {_big("sum(total_orders)")} as total_orders
        from customer_mart group by rollup (customer_state, customer_city)""",
    "delivery_by_month": _delivery(_MONTH_OF_KEY, "fulfillment"),
    "delivery_by_state": _delivery(
        "customer_state", "fulfillment join dim_customers using (customer_id)"
    ),
    "delivery_by_seller_state": _delivery(
        "seller_state",
        """fulfillment join (select distinct order_id, seller_id from fact_sales) s
             using (order_id) join dim_sellers using (seller_id)""",
    ),
    "review_trend": f"""
        select {_MONTH_OF_KEY}, count(*) as reviews,
               {_mean_int("review_score")} as avg_review_score
        from fulfillment where review_score is not null group by 1, 2""",
    "review_delay_correlation": f"""
        select count(*) as reviews,
               round(corr(delivery_delay_days, review_score), 6) as delay_score_corr,
               {_hundredths("sum(review_score) filter (where is_late_delivery = 1)",
                            "count(*) filter (where is_late_delivery = 1)")}
                 as avg_score_late,
               {_hundredths("sum(review_score) filter (where is_late_delivery = 0)",
                            "count(*) filter (where is_late_delivery = 0)")}
                 as avg_score_on_time
        from fulfillment
        where review_score is not null and delivery_delay_days is not null""",
    "product_extremes": """
        (select 'highest' as side, product_id, category, total_sales, total_quantity
         from product_mart order by total_sales desc, product_id limit 10)
        union all
        (select 'lowest' as side, product_id, category, total_sales, total_quantity
         from product_mart order by total_sales, product_id limit 10)""",
    "seller_ranking": f"""
        select seller_id, seller_state, total_orders, total_revenue, review_count,
               avg_review_score,
               dense_rank() over (order by total_orders desc) as order_rank,
               case when avg_review_score is not null then
                 dense_rank() over (order by avg_review_score desc nulls last) end
                 as review_rank
        from (select seller_id, count(*) as total_orders,
                     {_money("sum(cents)")} as total_revenue,
                     {_big("coalesce(sum(n), 0)")} as review_count,
                     {_hundredths("sum(score)", "sum(n)")} as avg_review_score
              from (select seller_id, order_id,
                           sum({_cents("total_item_value")}) as cents
                    from fact_sales group by 1, 2) sold
              left join (select order_id, sum(review_score) as score, count(*) as n
                         from fulfillment where review_score is not null
                         group by 1) scored using (order_id)
              group by 1) totals
        left join dim_sellers using (seller_id)""",
    "customer_concentration": _concentration("customer_state, customer_city"),
    "state_concentration": _concentration("customer_state"),
    "rfm_segments": _RFM,
    "rfm_segment_sizes": f"""
        select segment, count(*) as people,
               {_sum_money("monetary")} as total_monetary,
               {_money(_half_up(f"sum({_cents('monetary')})", "count(*)"))}
                 as avg_monetary
        from ({_RFM}) people group by 1""",
}

AFTER_CHANGES = {
    "mart_from_changes": "select * from sales_mart",
    "customer_mart_from_changes": "select * from customer_mart",
    "product_mart_from_changes": "select * from product_mart",
    "kpi_from_changes": "select * from kpi",
    "views_from_changes": f"""
        select 'vw_customer_state_summary' as view_name, customer_state as name,
               customer_count, total_revenue
        from ({_BY_STATE}) by_state
        union all
        select 'vw_customer_tiers', spending_tier, customer_count, total_revenue
        from ({_TIERS}) by_tier""",
}

ORACLES: dict[str, str] = {
    **{name: with_ctes(body) for name, body in BODIES.items()},
    **{name: with_ctes(body, _CHANGED) for name, body in AFTER_CHANGES.items()},
}
