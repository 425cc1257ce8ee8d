"""The five BI views as SQL text over registered marts.

The text uses the mart names as tables, so the same definition works as a
temporary view, as a persistent view in a database, and inline with DataFrames
passed as arguments to ``spark.sql``. Sums run over whole cents and quotients
are rounded in integers, as in ``bazaarlake.functions.money``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from bazaarlake import contracts as c


def _cents(column: str) -> str:
    return f"CAST(rint({column} * 100) AS BIGINT)"


def _total(column: str) -> str:
    return f"CAST(SUM({_cents(column)}) AS DOUBLE) / 100"


def _half_up(num: str, den: str) -> str:
    """``round(num / den)`` of two integer aggregates, away from zero, in SQL."""
    whole = f"((2 * ABS({num}) + {den}) DIV NULLIF(2 * {den}, 0))"
    return f"CAST(SIGN({num}) AS BIGINT) * {whole}"


def _mean_money(column: str) -> str:
    cents = f"SUM({_cents(column)})"
    return f"CAST({_half_up(cents, f'COUNT({column})')} AS DOUBLE) / 100"


def _mean_int(column: str) -> str:
    hundredths = f"SUM({column} * 100)"
    return f"CAST({_half_up(hundredths, f'COUNT({column})')} AS DOUBLE) / 100"


def _case(column: str, steps, rest: str) -> str:
    whens = " ".join(f"WHEN {column} >= {floor} THEN '{label}'" for floor, label in steps)
    return f"CASE {whens} ELSE '{rest}' END"


_REPEAT = "COUNT_IF(is_repeat_customer = 1)"
_REPEAT_PCT = f"CAST({_half_up(f'{_REPEAT} * 10000', 'COUNT(*)')} AS DOUBLE) / 100"
_MONTHLY_CENTS = f"SUM({_cents('total_revenue')})"

VIEWS: dict[str, str] = {
    "vw_monthly_sales": f"""
        SELECT year, month,
               {_total("total_revenue")} AS monthly_revenue,
               {_total("total_payment")} AS monthly_payment,
               SUM(total_orders) AS monthly_orders,
               SUM(total_items) AS monthly_items,
               {_total("total_freight")} AS monthly_freight,
               CAST({_half_up(_MONTHLY_CENTS, "SUM(total_orders)")} AS DOUBLE) / 100
                 AS avg_order_value
        FROM {{sales_summary_mart}}
        GROUP BY year, month""",
    "vw_category_performance": f"""
        SELECT category,
               COUNT(*) AS product_count,
               {_total("total_sales")} AS total_revenue,
               SUM(total_quantity) AS total_items,
               SUM(total_orders) AS total_orders,
               {_mean_money("avg_price")} AS avg_price,
               {_mean_money("avg_freight")} AS avg_freight,
               {_total("total_freight")} AS total_freight
        FROM {{product_mart}}
        GROUP BY category""",
    "vw_customer_state_summary": f"""
        SELECT customer_state,
               COUNT(*) AS customer_count,
               {_total("total_spent")} AS total_revenue,
               SUM(total_orders) AS total_orders,
               {_mean_money("total_spent")} AS avg_customer_value,
               {_REPEAT} AS repeat_customers,
               {_REPEAT_PCT} AS repeat_rate_pct
        FROM {{customer_mart}}
        GROUP BY customer_state""",
    "vw_customer_tiers": f"""
        SELECT {_case("total_spent", c.SPENDING_TIERS, c.SPENDING_TIER_REST)}
                 AS spending_tier,
               COUNT(*) AS customer_count,
               {_total("total_spent")} AS total_revenue,
               {_mean_int("total_orders")} AS avg_orders,
               {_mean_int("total_items_purchased")} AS avg_items
        FROM {{customer_mart}}
        GROUP BY 1""",
    "vw_weekday_weekend": f"""
        SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
               COUNT(*) AS num_days,
               {_total("total_revenue")} AS total_revenue,
               {_mean_money("total_revenue")} AS avg_daily_revenue,
               SUM(total_orders) AS total_orders,
               {_mean_int("total_orders")} AS avg_daily_orders
        FROM {{sales_summary_mart}}
        GROUP BY 1""",
}

_MART_OF = {
    name: next(m for m in c.PLATINUM if f"{{{m}}}" in text)
    for name, text in VIEWS.items()
}


def view_query(
    spark: SparkSession, name: str, marts: Mapping[str, DataFrame]
) -> DataFrame:
    """The rows of one view, with the marts given as DataFrames."""
    mart = _MART_OF[name]
    return spark.sql(VIEWS[name], **{mart: marts[mart]})


def create_temp_views(spark: SparkSession, marts: Mapping[str, DataFrame]) -> list[str]:
    """Register the marts and the five views as temporary views."""
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    for name, text in VIEWS.items():
        mart = _MART_OF[name]
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {text.format(**{mart: mart})}")
    return list(VIEWS)


def create_views(spark: SparkSession, database: str) -> list[str]:
    """Persist the five views next to the registered marts of ``database``."""
    for name, text in VIEWS.items():
        mart = _MART_OF[name]
        body = text.format(**{mart: f"{database}.{mart}"})
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body}")
    return list(VIEWS)
