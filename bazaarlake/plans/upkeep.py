"""Marts kept up from changes instead of being rebuilt.

A change to the clean tables touches orders. The sales lines and fulfillment rows of
touched orders are taken back as they were (sign -1) and added as they are (+1). From
signed rows come signed contributions, small additive rows per day, per customer and
day, per product, per seller and one for delivery and reviews. Their sums are the
states; a mart is its state, finished. A base build is the same with signs of +1.

- A distinct count of orders is additive because an order comes and goes whole. The
  first of its lines for a day, customer and product is marked where the lines of an
  order lie together anyway, so that no state shuffles them again.
- A last purchase date is no sum. The customers' state therefore keeps their days:
  when the last one empties, the one before shows.
- Untouched orders are scanned for their keys but not shuffled, as long as Spark can
  broadcast the touched keys by their measured size. Where there are too many of them, a
  filter of bounded size is broadcast, and only rows that share a touched order's bit are
  shuffled to find the right ones. The rows of touched orders are looked up once and
  written; changes are applied to them, not to whole tables.

A state is stored as one partition of contributions per change set. Repeating a change
set replaces its own partition. ``compact`` sums them into one.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from bazaarlake.contracts import POSITIVE_SCORE, RAW
from bazaarlake.functions.money import amount, cents, mean_amount, percent, ratio
from bazaarlake.lazy import Plans
from bazaarlake.operators.bits import bits_of, sharing
from bazaarlake.plans import gold, marts
from bazaarlake.session import passing
from bazaarlake.sources.layers import Lake

# Clean tables whose rows belong to an order.
OF_ORDERS = ("orders", "order_items", "order_payments", "order_reviews")

# Additive amounts of sales lines: each is a sum in cents and a count of values.
AMOUNTS = {
    "value": "total_item_value",
    "payment": "total_payment_value",
    "price": "price",
    "freight": "freight_value",
}
SALES = ["lines", "orders", "items", *AMOUNTS, *[f"{a}_n" for a in AMOUNTS]]
DELIVERY = ["arrived", "days", "delayed", "delay", "late", "scored", "score", "positive"]

# What the facts of touched orders are made of; other columns are not moved.
NEEDED = {
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score"],
}

#: States: key columns and additive measures.
STATES: dict[str, tuple[list[str], list[str]]] = {
    "daily": (["purchase_date_key"], SALES),
    "customers": (["customer_id", "purchase_date_key"], SALES),
    "products": (["product_id"], SALES),
    "sellers": (["seller_id"], ["lines"]),
    "delivery": ([], DELIVERY),
}

# States of sales lines in which an order counts once for a key.
SALES_OF = {name: keys for name, (keys, measures) in STATES.items() if measures is SALES}
_KEYS = sorted({key for keys in SALES_OF.values() for key in keys})


# ---- contributions of signed rows ----


def marked(signed: DataFrame) -> DataFrame:
    """What the states need of signed sales lines, and of which lines an order counts.

    For each key of SALES_OF one line of an order and sign has its ``first_`` mark.
    """
    slim = signed.select(
        "order_id", "order_item_id", "seller_id", *_KEYS, *AMOUNTS.values(), "sign"
    )
    # Partitions of the order alone: the lines are not shuffled for each key.
    one = Window.partitionBy("order_id")
    by_day, by_product = one.orderBy("sign", "purchase_date_key", "customer_id"), one.orderBy("sign", "product_id")

    def begins(along: WindowSpec, keys: list[str]) -> Column:
        here = F.struct("sign", *keys)
        return ~F.lag(here).over(along).eqNullSafe(here)

    once = {
        _first(state): begins(by_product if "product_id" in keys else by_day, keys)
        for state, keys in SALES_OF.items()
    }
    return slim.withColumns(once).drop("order_id")


def _first(state: str) -> str:
    return f"first_{state}"


def _sales(lines: DataFrame, state: str) -> DataFrame:
    """Contributions per key of ``marked`` lines. An order counts once for a key and sign."""
    one = F.lit(1)
    values = {
        "lines": one,
        "orders": F.when(F.col(_first(state)), one),
        "items": F.when(F.col("order_item_id").isNotNull(), one),
        **{a: cents(F.col(c)) for a, c in AMOUNTS.items()},
        **{f"{a}_n": F.when(F.col(c).isNotNull(), one) for a, c in AMOUNTS.items()},
    }
    sign = F.col("sign")
    return lines.groupBy(*SALES_OF[state]).agg(
        *[F.coalesce(F.sum(sign * values[m]), F.lit(0)).cast("bigint").alias(m) for m in SALES]
    )


def _delivery(signed: DataFrame) -> DataFrame:
    days, delay, score = map(
        F.col, ("shipping_duration_days", "delivery_delay_days", "review_score")
    )
    arrived = days.isNotNull()
    one = F.lit(1)
    values = {
        "arrived": F.when(arrived, one),
        "days": days,
        "delayed": F.when(arrived & delay.isNotNull(), one),
        "delay": F.when(arrived, delay),
        "late": F.when(arrived, F.col("is_late_delivery")),
        "scored": F.when(score.isNotNull(), one),
        "score": score,
        "positive": F.when(score >= POSITIVE_SCORE, one),
    }
    sign = F.col("sign")
    return signed.agg(
        *[F.coalesce(F.sum(sign * v), F.lit(0)).cast("bigint").alias(m) for m, v in values.items()]
    )


def contributions(sales: DataFrame, fulfillment: DataFrame) -> Plans:
    """All states' contributions of marked sales lines and signed fulfillment rows."""
    return Plans(
        {
            **{state: lambda state=state: _sales(sales, state) for state in SALES_OF},
            "sellers": lambda: sales.groupBy("seller_id").agg(
                F.sum("sign").cast("bigint").alias("lines")
            ),
            "delivery": lambda: _delivery(fulfillment),
        }
    )


# ---- from changes of clean tables to signed rows ----


def touched_orders(before: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of the orders whose rows the changes replace or add, each once."""
    parts = []
    for name in OF_ORDERS:
        if name not in changes:
            continue
        parts.append(changes[name].select("order_id"))
        keys = list(RAW[name].keys)
        if "order_id" not in keys:  # a row may leave another order
            fresh = changes[name].select(*keys)
            parts.append(before[name].join(fresh, keys, "left_semi").select("order_id"))
    return reduce(DataFrame.unionByName, parts).dropna().distinct()


def changed(before: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The clean tables after their changes: rows of a key replace all rows of that key."""

    def after(name: str) -> DataFrame:
        old, new = before[name], changes[name]
        kept = old.join(new, list(RAW[name].keys), "left_anti")
        return kept.unionByName(new.select(*old.columns))

    return {name: after(name) if name in changes else before[name] for name in before}


def _of(
    tables: Mapping[str, DataFrame], touched: DataFrame, bits: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The rows of touched orders; with ``bits``, most others go before any shuffle."""

    def rows(name: str) -> DataFrame:
        found = tables[name].select(*NEEDED[name])
        if bits is not None:
            found = sharing(found, F.col("order_id"), bits)
        return found.join(touched, "order_id", "left_semi")

    return {name: rows(name) for name in OF_ORDERS}


def _signed(of: Mapping[str, DataFrame], sign: int) -> tuple[DataFrame, DataFrame]:
    lines = gold.fact_sales(of["order_items"], of["orders"], of["order_payments"])
    steps = gold.fact_order_fulfillment(of["orders"], of["order_reviews"])
    return lines.withColumn("sign", F.lit(sign)), steps.withColumn("sign", F.lit(sign))


def _both(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    taken, added = _signed(old, -1), _signed(new, 1)
    return taken[0].unionByName(added[0]), taken[1].unionByName(added[1])


def signed_changes(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], touched: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(sales lines, fulfillment rows) of touched orders, taken back and added."""
    return _both(_of(before, touched), _of(after, touched))


# ---- states ----


def summed(parts: DataFrame, state: str) -> DataFrame:
    """A state from its contributions; keys without rows are gone."""
    keys, measures = STATES[state]
    total = parts.groupBy(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])
    return total.filter("lines > 0") if "lines" in measures else total


class Upkeep:
    """States in the gold layer, a partition of contributions for each change set."""

    def __init__(self, lake: Lake):
        self.lake = lake

    @staticmethod
    def table(state: str) -> str:
        return f"state_{state}"

    def add(self, parts: Mapping[str, DataFrame], change_set: str) -> None:
        """Store contributions; those of the same change set are replaced."""
        for state in parts:
            self.lake.write(
                parts[state].withColumn("change_set", F.lit(change_set)),
                "gold",
                self.table(state),
                partition_by=["change_set"],
                dynamic=True,
            )

    def build(self, sales: DataFrame, fulfillment: DataFrame) -> None:
        """States of whole facts."""
        one = F.lit(1)
        with passing(marked(sales.withColumn("sign", one)), "base-lines") as lines:
            self.add(contributions(lines, fulfillment.withColumn("sign", one)), "base")

    def apply(
        self, before: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], change_set: str
    ) -> dict[str, DataFrame]:
        """Carry changes of clean tables into the states; returns the tables after them."""
        after = changed(before, changes)
        with ExitStack() as held:
            touched = held.enter_context(passing(touched_orders(before, changes), "touched"))
            bits = held.enter_context(passing(bits_of(touched, "order_id"), "touched-bits"))
            old = {
                name: held.enter_context(passing(rows, f"touched-{name}"))
                for name, rows in _of(before, touched, bits).items()
            }
            # Every changed row is of a touched order; one without an order is of none.
            fresh = {
                n: changes[n].select(*NEEDED[n]).filter(F.col("order_id").isNotNull())
                for n in OF_ORDERS
                if n in changes
            }
            sales, steps = _both(old, changed(old, fresh))
            lines = held.enter_context(passing(marked(sales), "signed-sales"))
            self.add(contributions(lines, steps), change_set)
        return after

    def parts(self, state: str) -> DataFrame:
        keys, measures = STATES[state]
        ddl = [f"{k} {'int' if k == 'purchase_date_key' else 'string'}" for k in keys]
        ddl += [f"{m} bigint" for m in measures]
        # Declared, as a state without rows has no file to tell its columns.
        reader = self.lake.spark.read.format(self.lake.table_format("gold"))
        if self.lake.table_format("gold") == "parquet":
            reader = reader.schema(", ".join([*ddl, "change_set string"]))
        return reader.load(self.lake.path("gold", self.table(state)))

    def state(self, state: str) -> DataFrame:
        return summed(self.parts(state), state)

    def compact(self, state: str) -> int:
        """One partition instead of one for each change set; returns its rows."""
        whole = self.state(state).withColumn("change_set", F.lit("base"))
        with passing(whole, "compact") as rows:
            return self.lake.write(rows, "gold", self.table(state), partition_by=["change_set"])

    def marts(self, star: Mapping[str, DataFrame]) -> Plans:
        """All four marts; ``star`` gives the dimensions."""
        return finished({s: self.state(s) for s in STATES}, star)


# ---- marts from states ----


def _amount(measure: str) -> Column:
    """NULL, as a sum of nothing is, without any value."""
    return F.when(F.col(f"{measure}_n") > 0, amount(F.col(measure)))


def _mean(measure: str) -> Column:
    n = F.col(f"{measure}_n")
    return F.when(n > 0, mean_amount(F.col(measure), n))


def _per_order(measure: str) -> Column:
    return F.when(F.col(f"{measure}_n") > 0, mean_amount(F.col(measure), F.col("orders")))


def daily_mart(state: DataFrame, dim_date: DataFrame, *, densify: bool = False) -> DataFrame:
    daily = state.select(
        "purchase_date_key",
        _amount("value").alias("total_revenue"),
        _amount("payment").alias("total_payment"),
        F.col("orders").alias("total_orders"),
        F.col("items").alias("total_items"),
        _per_order("value").alias("avg_order_value"),
        _mean("price").alias("avg_item_price"),
        _amount("freight").alias("total_freight"),
    )
    return marts.with_calendar(daily, dim_date, densify=densify)


def customer_mart(state: DataFrame, dim_customers: DataFrame, dim_date: DataFrame) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in SALES]
    per_customer = (
        state.groupBy("customer_id")
        .agg(*sums, F.max("purchase_date_key").alias("last_purchase_date_key"))
        .select(
            "customer_id",
            F.col("orders").alias("total_orders"),
            _amount("value").alias("total_spent"),
            _per_order("value").alias("avg_order_value"),
            F.col("items").alias("total_items_purchased"),
            _amount("freight").alias("total_freight_paid"),
            _mean("price").alias("avg_item_price"),
            "last_purchase_date_key",
        )
    )
    return marts.with_customer(per_customer, dim_customers, dim_date)


def product_mart(state: DataFrame, dim_products: DataFrame) -> DataFrame:
    per_product = state.select(
        "product_id",
        _amount("value").alias("total_sales"),
        F.col("items").alias("total_quantity"),
        F.col("orders").alias("total_orders"),
        _mean("price").alias("avg_price"),
        _mean("freight").alias("avg_freight"),
        _amount("freight").alias("total_freight"),
    )
    return marts.with_product(per_product, dim_products)


def kpi_summary(
    daily: DataFrame, customers: DataFrame, products: DataFrame, sellers: DataFrame, delivery: DataFrame
) -> DataFrame:
    buyers = customers.groupBy("customer_id").agg(F.sum("orders").alias("orders"))
    return marts.headline(
        daily.agg(
            F.sum(F.col("value").cast("decimal(28,0)")).alias("revenue"),
            F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        ),
        buyers.agg(
            F.count("customer_id").alias("total_customers"),
            F.count_if(F.col("orders") > 1).alias("repeat_customer_count"),
        ),
        products.agg(F.count("product_id").alias("total_products")),
        sellers.agg(F.count("seller_id").alias("total_sellers")),
        delivery.select(
            ratio(F.col("days"), F.col("arrived")).alias("avg_delivery_time_days"),
            ratio(F.col("delay"), F.col("delayed")).alias("avg_delivery_delay_days"),
            percent(F.col("late"), F.col("arrived")).alias("late_delivery_rate_pct"),
            ratio(F.col("score"), F.col("scored")).alias("avg_review_score"),
            percent(F.col("positive"), F.col("scored")).alias("positive_review_rate_pct"),
            F.col("scored").alias("total_reviews"),
        ),
    )


def finished(states: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> Plans:
    """The four marts of states."""
    return Plans(
        {
            "sales_summary_mart": lambda: daily_mart(states["daily"], star["dim_date"]),
            "customer_mart": lambda: customer_mart(
                states["customers"], star["dim_customers"], star["dim_date"]
            ),
            "product_mart": lambda: product_mart(states["products"], star["dim_products"]),
            "kpi_summary": lambda: kpi_summary(
                *[states[s] for s in ("daily", "customers", "products", "sellers", "delivery")]
            ),
        }
    )
