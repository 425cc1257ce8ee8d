"""Every query by name, over the sample tables of one folder.

A query is a function ``(spark, sf_dir) -> DataFrame``. All of them start from
the whole sample tables and go through the same transforms a lake would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.contracts import GOLD, PLATINUM, RAW
from bazaarlake.functions.dates import date_key
from bazaarlake.functions.growth import period_growth
from bazaarlake.functions.money import sum_money
from bazaarlake.lazy import Plans
from bazaarlake.operators import profile, quality, reconcile
from bazaarlake.operators.asof import asof_join
from bazaarlake.operators.cleaning import clean_all, clean_geolocation
from bazaarlake.operators.schema import normalize_types
from bazaarlake.operators.upsert import upsert, upsert_partitions
from bazaarlake.plans import gold, insights, marts, reports, sketches, upkeep, views
from bazaarlake.plans.pipeline import FACT_CLUSTERS, FACT_PARTITIONS
from bazaarlake.session import SMALL_TASKS, durable, scratch_path, settings, tune
from bazaarlake.sources import catalog, zorder
from bazaarlake.sources.bucketed import BucketedTable
from bazaarlake.sources.csv_drop import full_load, incremental_load, read_csv, validate_layer
from bazaarlake.sources.csv_records import read_records
from bazaarlake.sources.layers import Lake, clustered, with_period
from bazaarlake.sources.star_sample import raw_tables
from bazaarlake.streaming.daily_mart import daily_mart, start_daily_mart
from bazaarlake.streaming.drops import start_upserts

Query = Callable[[SparkSession, str], DataFrame]


class Sample:
    """The layers over one sample folder, built lazily and only on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark, SMALL_TASKS)
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> Plans:
        return raw_tables(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> Plans:
        return clean_all(self.raw)

    @cached_property
    def star(self) -> Plans:
        return gold.star_schema(self.clean)

    @cached_property
    def written_star(self) -> Plans:
        """The star schema with its facts written to shared storage when used.

        For plans that read a fact more than once: its joins then run once.
        """
        facts = ("fact_sales", "fact_order_fulfillment")
        return Plans(
            {
                name: lambda n=name: durable(self.star[n], n)
                if n in facts
                else self.star[n]
                for name in self.star
            }
        )

    @cached_property
    def marts(self) -> Plans:
        """Each mart on its own; only the KPI row reads a fact several times."""
        separate = marts.all_marts(self.star)
        return Plans(
            {
                **{name: lambda n=name: separate[n] for name in separate},
                "kpi_summary": lambda: marts.kpi_summary(
                    durable(
                        self.star["fact_sales"].select(*marts.KPI_SALES_COLUMNS),
                        "kpi-lines",
                    ),
                    self.fulfillment,
                ),
            }
        )

    @cached_property
    def all_marts(self) -> Plans:
        """All marts together, over facts written once."""
        return marts.all_marts(self.written_star)

    @property
    def sales(self) -> DataFrame:
        return self.marts["sales_summary_mart"]

    @property
    def customers(self) -> DataFrame:
        return self.marts["customer_mart"]

    @property
    def products(self) -> DataFrame:
        return self.marts["product_mart"]

    @property
    def fulfillment(self) -> DataFrame:
        return self.star["fact_order_fulfillment"]

    def fresh_lake(self, label: str) -> Lake:
        return Lake(self.spark, scratch_path(self.spark, label))


QUERIES: dict[str, Query] = {}


def query(function=None, *, name: str | None = None):
    """Register ``function(sample)`` as a query under its own or given name."""

    def register(build):
        QUERIES[name or build.__name__] = lambda spark, sf_dir: build(
            Sample(spark, sf_dir)
        )
        return build

    return register(function) if function else register


def _register_each() -> None:
    """Queries that are one table or one report of the layers."""
    for table in RAW:
        query(lambda s, t=table: s.clean[t], name=f"clean_{table}")
    for table in GOLD:
        query(lambda s, t=table: s.star[t], name=table)
    for table in PLATINUM:
        query(lambda s, t=table: s.marts[t], name=table)
    for name, report, mart in (
        ("q03_headline_kpis", reports.headline_kpis, "kpi_summary"),
        ("q04_daily_trend", reports.daily_trend, "sales_summary_mart"),
        ("q05_monthly_revenue", reports.monthly_revenue, "sales_summary_mart"),
        ("q06_quarterly_revenue", reports.quarterly_revenue, "sales_summary_mart"),
        ("q07_weekend_vs_weekday", reports.weekend_vs_weekday, "sales_summary_mart"),
        ("q08_revenue_by_weekday", reports.revenue_by_weekday, "sales_summary_mart"),
        ("q09_top_revenue_days", reports.top_revenue_days, "sales_summary_mart"),
        ("q10_top_growth_days", reports.top_growth_days, "sales_summary_mart"),
        ("q11_top_customers", reports.top_customers, "customer_mart"),
        ("q12_customers_by_state", reports.customers_by_state, "customer_mart"),
        ("q13_repeat_vs_one_time", reports.repeat_vs_one_time, "customer_mart"),
        ("q14_spending_tiers", reports.spending_tiers, "customer_mart"),
        ("q15_top_cities", reports.top_cities, "customer_mart"),
        ("q16_top_products", reports.top_products, "product_mart"),
        ("q17_sales_by_category", reports.sales_by_category, "product_mart"),
        ("q18_top_categories", reports.top_categories, "product_mart"),
        ("q19_weight_vs_freight", reports.weight_vs_freight, "product_mart"),
        ("q20_product_volumes", reports.product_volumes, "product_mart"),
        ("q21_top_states", reports.top_states, "customer_mart"),
        ("q22_category_performance", reports.category_performance, "product_mart"),
    ):
        query(lambda s, r=report, m=mart: r(s.marts[m]), name=name)
    for mart, contract in PLATINUM.items():
        query(
            lambda s, m=mart, k=contract.keys: reports.preview(s.marts[m], k),
            name=f"q02_preview_{mart}",
        )
    for view in views.VIEWS:
        query(lambda s, v=view: views.view_query(s.spark, v, s.marts), name=view)


_register_each()


# ---- cleaning and modelling variants ----


@query
def clean_geolocation_lookup(s: Sample) -> DataFrame:
    return clean_geolocation(s.raw["geolocation"], one_per_zip=True)


@query
def geo_centroid(s: Sample) -> DataFrame:
    return gold.geo_centroid(s.clean["geolocation"])


@query
def sales_summary_payments_once(s: Sample) -> DataFrame:
    """Daily sales with each order's payment counted once."""
    return marts.sales_summary_mart(
        s.written_star["fact_sales"], s.star["dim_date"], payments_once=True
    ).select("purchase_date_key", "total_payment", "total_payment_orders")


@query
def sales_summary_densified(s: Sample) -> DataFrame:
    """Daily sales with growth against the calendar day before."""
    return marts.sales_summary_mart(
        s.star["fact_sales"], s.star["dim_date"], densify=True
    )


@query
def kpi_summary_by_person(s: Sample) -> DataFrame:
    """Headline figures with customers told apart by person."""
    lines = marts.with_person(
        s.star["fact_sales"].select(*marts.KPI_SALES_COLUMNS), s.star["dim_customers"]
    )
    return marts.kpi_summary(
        durable(lines, "person-lines"),
        s.fulfillment,
        customer_key="customer_unique_id",
    )


@query(name="period_growth")
def growth_by_status(s: Sample) -> DataFrame:
    """Month-over-month revenue growth within each order status."""
    monthly = (
        s.star["fact_sales"]
        .withColumn("period", F.floor(F.col("purchase_date_key") / 100).cast("int"))
        .groupBy("order_status", "period")
        .agg(sum_money(F.col("total_item_value")).alias("revenue"))
    )
    return period_growth(monthly, "revenue", "period", ["order_status"])


@query(name="normalize_schema")
def normalized_products(s: Sample) -> DataFrame:
    """Integer measures of the source as the doubles the star schema declares."""
    return normalize_types(
        s.raw["products"],
        {f.name: f.dataType for f in RAW["products"].schema.fields},
    )


# ---- mart checks ----


@query
def q01_row_counts(s: Sample) -> DataFrame:
    return reports.mart_row_counts(s.all_marts)


# ---- quality ----


@query
def profile_columns(s: Sample) -> DataFrame:
    return quality.profile_columns(s.raw["order_reviews"])


@query
def null_counts(s: Sample) -> DataFrame:
    return quality.null_counts(s.clean["orders"])


@query
def negative_counts(s: Sample) -> DataFrame:
    return quality.negative_counts(
        s.raw["geolocation"], ["geolocation_lat", "geolocation_lng"]
    ).unionByName(
        quality.negative_counts(
            s.raw["order_payments"],
            ["payment_sequential", "payment_installments", "payment_value"],
        )
    )


@query
def duplicate_keys(s: Sample) -> DataFrame:
    return quality.duplicate_keys(s.raw["order_items"], RAW["order_items"].keys)


@query
def orphan_payments(s: Sample) -> DataFrame:
    return quality.orphan_rows(s.raw["order_payments"], s.raw["orders"], "order_id")


@query
def orphan_customer_zips(s: Sample) -> DataFrame:
    return quality.orphan_rows(
        s.clean["customers"],
        s.clean["geolocation"],
        "customer_zip_code_prefix",
        "geolocation_zip_code_prefix",
    )


@query
def temporal_violations(s: Sample) -> DataFrame:
    return quality.temporal_violations(
        s.clean["order_reviews"], "review_creation_date", "review_answer_timestamp"
    )


@query
def value_frequency(s: Sample) -> DataFrame:
    return quality.value_frequency(s.clean["order_payments"], "payment_type")


@query
def distinct_values(s: Sample) -> DataFrame:
    return quality.distinct_values(s.clean["customers"], "customer_city")


@query
def matching_cities(s: Sample) -> DataFrame:
    return quality.matching(s.clean["customers"], "customer_city", "city 1%")


@query
def zip_ranges(s: Sample) -> DataFrame:
    # Cleaning cuts zips to five digits, so their length shows in the raw numbers
    # only; what a number has lost are its leading zeros.
    raw = F.col("customer_zip_code_prefix").cast("string")
    padded = F.when(F.length(raw) < 5, F.lpad(raw, 5, "0")).otherwise(raw)
    return quality.zip_ranges(s.raw["customers"].select(padded.alias("zip")), "zip")


@query
def reconcile_payments(s: Sample) -> DataFrame:
    return quality.payment_mismatches(s.star["fact_sales"])


@query
def row_count_report(s: Sample) -> DataFrame:
    return quality.row_counts({**s.clean, **s.star})


@query
def validate_counts(s: Sample) -> DataFrame:
    """Clean against source row counts: FAIL where cleaning drops rows."""
    expected = quality.row_counts(s.raw).withColumnRenamed(
        "row_count", "expected_count"
    )
    return quality.validate_counts(quality.row_counts(s.clean), expected)


# ---- upsert, loads, layout, catalog ----


def _customer_changes(s: Sample) -> tuple[DataFrame, DataFrame]:
    """Customers but every tenth, and changes: the missing ones and every
    seventh with a new city."""
    k = F.col("customer_id").cast("bigint")
    customers = s.clean["customers"]
    known = customers.filter(k % 10 != 0)
    changes = customers.filter((k % 10 == 0) | (k % 7 == 0)).withColumn(
        "customer_city", F.concat(F.lit("new "), "customer_city")
    )
    return known, changes


@query
def upsert_by_key(s: Sample) -> DataFrame:
    known, changes = _customer_changes(s)
    return upsert(known, changes, RAW["customers"].keys)


@query(name="upsert_partitions")
def upsert_latest_year(s: Sample) -> DataFrame:
    """Orders of the latest year re-sent as closed: only their months result."""
    placed = F.col("order_purchase_timestamp")
    orders = with_period(
        s.clean["orders"]
        .select("order_id", "customer_id", "order_status", date_key(placed).alias("day")),
        "day",
    )
    last_year = orders.agg(F.max("year")).scalar()
    changes = orders.filter(
        (F.col("year") == last_year) & (F.col("order_id").cast("bigint") % 2 == 0)
    ).withColumn("order_status", F.lit("closed"))
    return upsert_partitions(orders, changes, ["order_id"], ["year", "month"])


def _write_csv(tables: Mapping[str, DataFrame], folder: str, file_name: str) -> None:
    for name, df in tables.items():
        df.write.csv(
            f"{folder}/{file_name.format(table=name)}", header=True, escape='"'
        )


@query
def csv_full_load(s: Sample) -> DataFrame:
    """All source tables written as CSV drops and loaded into bronze."""
    lake = s.fresh_lake("csv-full")
    folder = f"{lake.root}/drop"
    _write_csv(s.raw, folder, "{table}.csv")
    return full_load(lake, folder)


@query
def csv_scan(s: Sample) -> DataFrame:
    """Review texts with line breaks, commas and quotes, through CSV and back."""
    folder = scratch_path(s.spark, "csv-scan")
    odd = F.concat(F.lit('said "yes",\nthen '), F.col("review_comment_message"))
    written = s.clean["order_reviews"].withColumn("review_comment_message", odd)
    written.write.csv(folder, header=True, escape='"')
    return read_csv(s.spark, folder, RAW["order_reviews"])


@query
def csv_records_scan(s: Sample) -> DataFrame:
    """The same kind of file as ``csv_scan``'s, cut into blocks that many tasks read."""
    folder = scratch_path(s.spark, "csv-records")
    odd = F.concat(F.lit('said "yes",\nthen '), F.col("review_comment_message"))
    written = s.clean["order_reviews"].withColumn("review_comment_message", odd)
    written.write.csv(folder, header=True, escape='"')
    with read_records(s.spark, folder, RAW["order_reviews"]) as rows:
        return durable(rows, "records")


@query
def csv_incremental_load(s: Sample) -> DataFrame:
    """Bronze customers after a full load and an increment; others skipped."""
    lake = s.fresh_lake("csv-increment")
    known, changes = _customer_changes(s)
    _write_csv({"customers": known}, f"{lake.root}/drop", "{table}.csv")
    _write_csv({"customers": changes}, f"{lake.root}/drop", "{table}_new.csv")
    full_load(lake, f"{lake.root}/drop", tables={"customers": RAW["customers"]})
    incremental_load(lake, f"{lake.root}/drop")
    return lake.read("bronze", "customers")


@query
def stream_upsert(s: Sample) -> DataFrame:
    """Bronze customers after a stream of two drops on top of a base table."""
    lake = s.fresh_lake("stream")
    drops, checkpoint = f"{lake.root}/drops", f"{lake.root}/checkpoint"
    known, changes = _customer_changes(s)
    contract = RAW["customers"]
    lake.write(known, "bronze", "customers")
    for part in (
        changes.filter("customer_city LIKE '%1'"),
        changes.filter("customer_city NOT LIKE '%1'"),
    ):
        part.write.mode("append").csv(drops, header=True, escape='"')
        start_upserts(lake, drops, contract, checkpoint).awaitTermination()
    return lake.read("bronze", "customers")


@query
def partitioned_fact_sales(s: Sample) -> DataFrame:
    """One year of the clustered, month-partitioned fact: other years unread."""
    lake = s.fresh_lake("layout")
    laid_out = clustered(
        with_period(s.star["fact_sales"]), FACT_PARTITIONS, FACT_CLUSTERS["fact_sales"]
    )
    lake.write(laid_out, "gold", "fact_sales", partition_by=FACT_PARTITIONS)
    return lake.read("gold", "fact_sales").filter("year = 1997")


@query
def catalog_view(s: Sample) -> DataFrame:
    """A persistent BI view over a registered external mart table."""
    lake = s.fresh_lake("catalog")
    database = lake.root.rsplit("/", 1)[1].replace("-", "_")
    for name in PLATINUM:
        lake.write(s.all_marts[name], "platinum", name)
    catalog.create_database(s.spark, database, f"{lake.root}/database")
    catalog.register(lake, database)
    views.create_views(s.spark, database)
    return s.spark.table(f"{database}.vw_customer_tiers")


@query
def csv_incremental_partitioned(s: Sample) -> DataFrame:
    """Bronze customers in a bucketed table: the increment rewrites touched buckets only."""
    lake = s.fresh_lake("csv-buckets")
    known, changes = _customer_changes(s)
    _write_csv({"customers": known}, f"{lake.root}/drop", "{table}.csv")
    _write_csv({"customers": changes}, f"{lake.root}/drop", "{table}_new.csv")
    only = {"customers": RAW["customers"]}
    full_load(lake, f"{lake.root}/drop", tables=only)
    database = lake.root.rsplit("/", 1)[1].replace("-", "_")
    table = BucketedTable(lake, RAW["customers"], database, buckets=16)
    table.create(lake.read("bronze", "customers"))
    incremental_load(
        lake, f"{lake.root}/drop", tables=only, merge_with=lambda _lake, _contract, fresh: table.merge(fresh)
    )
    return table.read()


@query
def replace_table(s: Sample) -> DataFrame:
    """A silver table replaced by rows made from itself."""
    lake = s.fresh_lake("replace")
    lake.write(s.clean["sellers"], "silver", "sellers")
    north = lake.read("silver", "sellers").filter(F.col("seller_id").cast("bigint") % 2 == 0)
    lake.replace(north, "silver", "sellers")
    return lake.read("silver", "sellers")


@query
def table_existence(s: Sample) -> DataFrame:
    """Which clean tables a lake has after two of them were written, with their rows."""
    lake = s.fresh_lake("existence")
    lake.write_all(s.clean, "silver", ["sellers", "orders"])
    return validate_layer(lake, "silver", list(RAW))


@query
def clustered_fact_scan(s: Sample) -> DataFrame:
    """Sales clustered on product and day: what a filter on either one opens and finds,
    for the first twenty values of both."""
    lake = s.fresh_lake("z-order")
    columns = ["product_id", "purchase_date_key"]
    laid_out = zorder.z_ordered(durable(s.star["fact_sales"], "lines"), columns, files=64)
    lake.write(laid_out, "gold", "fact_sales")
    stored = lake.read("gold", "fact_sales")
    per_column = []
    for column in columns:
        first = stored.select(column).dropna().distinct().orderBy(column).limit(20)
        met = zorder.files_met(stored, column, [r[0] for r in first.collect()])
        lines = stored.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("lines"))
        per_column.append(
            met.join(lines, "value").select(
                F.lit(column).alias("column_name"),
                F.col("value").cast("string").alias("value"),
                "lines",
                (F.col("files") * 3 < F.col("all_files")).alias("under_a_third"),
            )
        )
    return per_column[0].unionByName(per_column[1])


@query
def price_as_of_purchase(s: Sample) -> DataFrame:
    """Each sales line with the highest price of its product on the last day before."""
    lines = durable(
        s.star["fact_sales"].select("order_id", "order_item_id", "product_id", "purchase_date_key", "price"),
        "lines",
    )
    days = lines.withColumn(
        "day", F.datediff(F.to_date(F.col("purchase_date_key").cast("string"), "yyyyMMdd"), F.lit("1990-01-01"))
    )
    history = days.groupBy("product_id", F.col("day").alias("listed_day")).agg(
        F.max("price").alias("listed_price")
    )
    return asof_join(
        days, history, ["product_id"], "day", "listed_day", ["listed_price", "listed_day"], strictly=True
    ).drop("day")


@query
def layer_difference(s: Sample) -> DataFrame:
    """Orders that differ between two copies of a layer, found by checksums of buckets."""
    lake = s.fresh_lake("reconcile")
    number = F.col("order_id").cast("bigint")
    old = s.clean["orders"]
    new = old.filter(number % 101 != 3).withColumn(
        "order_status", F.when(number % 97 == 5, "X").otherwise(F.col("order_status"))
    )
    more = old.filter(number % 103 == 7).withColumn("order_id", F.concat("order_id", F.lit("Z")))
    for name, rows in (("orders", old), ("orders_copy", new.unionByName(more))):
        bucketed = reconcile.with_bucket(rows, ["order_id"], 64)
        lake.write(bucketed, "silver", name, partition_by=[reconcile.BUCKET])
    return reconcile.table_difference(
        lake.read("silver", "orders"), lake.read("silver", "orders_copy"), ["order_id"]
    )


# ---- marts kept up from changes ----


def _order_changes(s: Sample) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(clean tables, changes to them): orders that move to other days and customers,
    other prices, products, payments and scores, and orders not seen before."""
    number = F.col("order_id").try_cast("bigint")

    def when(divisor: int, rest: int, value, column: str):
        return F.when(number % divisor == rest, value).otherwise(F.col(column))

    bought, first = F.col("order_purchase_timestamp"), F.col("order_item_id") == 1
    edits = {
        "orders": (13, 2, {
            "customer_id": when(39, 2, F.lit("1"), "customer_id"),
            "order_purchase_timestamp": bought + F.expr("INTERVAL 3 DAYS"),
        }),
        "order_items": (17, 5, {
            "price": F.col("price") + 1.5,
            "product_id": F.when(first, F.lit("7")).otherwise(F.col("product_id")),
        }),
        "order_payments": (19, 3, {"payment_value": F.col("payment_value") + 2.25}),
        "order_reviews": (23, 4, {"review_score": F.lit(5)}),
    }
    before, changes = {}, {}
    for name, (divisor, rest, columns) in edits.items():
        # Cleaned and written once, what the facts need of it: both parts are read from the same files.
        table = durable(s.clean[name].select(*upkeep.NEEDED[name]), f"clean-{name}")
        edited = table.withColumns(
            {c: when(divisor, rest, value, c).cast(table.schema[c].dataType) for c, value in columns.items()}
        )
        before[name] = table.filter(number % 29 != 0)
        changes[name] = durable(edited.filter((number % divisor == rest) | (number % 29 == 0)), f"new-{name}")
    return before, changes


def _kept_up(s: Sample, label: str) -> Plans:
    """Marts of states built before the changes, which were then carried through."""
    before, changes = _order_changes(s)
    kept = upkeep.Upkeep(s.fresh_lake(label))
    star = gold.star_schema(before)
    kept.build(star["fact_sales"], star["fact_order_fulfillment"])
    after = kept.apply(before, changes, "changes")
    dims = {name: s.clean[name] for name in s.clean if name not in after}
    return kept.marts(gold.star_schema({**dims, **after}))


@query
def mart_from_changes(s: Sample) -> DataFrame:
    return _kept_up(s, "daily-upkeep")["sales_summary_mart"]


@query
def customer_mart_from_changes(s: Sample) -> DataFrame:
    return _kept_up(s, "customer-upkeep")["customer_mart"]


@query
def product_mart_from_changes(s: Sample) -> DataFrame:
    return _kept_up(s, "product-upkeep")["product_mart"]


@query
def kpi_from_changes(s: Sample) -> DataFrame:
    return _kept_up(s, "kpi-upkeep")["kpi_summary"]


@query
def views_from_changes(s: Sample) -> DataFrame:
    """Customers by state and tier: two BI views over marts that changes keep up."""
    kept = _kept_up(s, "view-upkeep")
    kept = {"customer_mart": durable(kept["customer_mart"], "kept-customers")}
    by_state, by_tier = (
        views.view_query(s.spark, name, kept).select(
            F.lit(name).alias("view_name"),
            F.col(group).alias("name"),
            F.col("customer_count").cast("bigint").alias("customer_count"),
            "total_revenue",
        )
        for name, group in (
            ("vw_customer_state_summary", "customer_state"),
            ("vw_customer_tiers", "spending_tier"),
        )
    )
    return by_state.unionByName(by_tier)


@query
def stream_daily_mart(s: Sample) -> DataFrame:
    """The daily mart after three drops through the state store.

    Lines of some orders and headers of others come late, and the second drop
    delivers the first one's lines again. The sample repeats line numbers, which the
    mart does not show; here every line of an order gets a number of its own.
    """
    lake = s.fresh_lake("stream-mart")
    folder, checkpoint = f"{lake.root}/drops", f"{lake.root}/checkpoint"
    number = F.coalesce(F.col("order_id").try_cast("bigint"), F.lit(0))
    late_lines, late_head = number % 5 == 0, number % 7 == 0
    first, last = number % 3 == 0, number % 3 == 2
    drops = (
        {
            "orders": first & ~late_head,
            "order_items": first & ~late_lines,
            "order_payments": first | last,
        },
        {"orders": number % 3 == 1, "order_items": (first & ~late_lines) | (number % 3 == 1)},
        {
            "orders": last | (first & late_head),
            "order_items": last | (first & late_lines),
            "order_payments": number % 3 == 1,
        },
    )
    one = Window.partitionBy("order_id").orderBy(*RAW["order_items"].columns)
    lines = s.raw["order_items"].withColumn("order_item_id", F.row_number().over(one))
    tables = {**s.raw, "order_items": durable(lines, "numbered-lines")}
    # A task writes and parses no more CSV than takes a few seconds.
    with settings(s.spark, {"spark.sql.files.maxPartitionBytes": "32m"}):
        for drop in drops:
            for name, wanted in drop.items():
                rows = tables[name].filter(wanted)
                rows.write.mode("append").csv(f"{folder}/{name}", header=True, escape='"')
            start_daily_mart(lake, folder, checkpoint).awaitTermination()
    return daily_mart(lake)


# ---- mergeable states ----


def _customer_states(s: Sample) -> DataFrame:
    """Days' sketches stored in three lots, the last of them a lot again."""
    lake = s.fresh_lake("visitors")
    lines = durable(s.star["fact_sales"].select("customer_id", "purchase_date_key", "order_id"), "lines")
    half = F.col("order_id").cast("bigint") % 2
    for name, rest in (("even", 0), ("odd", 1), ("odd-again", 1)):
        states = sketches.daily_customers(lines.filter(half == rest))
        sketches.add_states(lake, "customers", states, name)
    return sketches.states(lake, "customers")


@query
def distinct_customers_by_period(s: Sample) -> DataFrame:
    return sketches.distinct_by_period(_customer_states(s))


@query
def customer_flow_by_month(s: Sample) -> DataFrame:
    return sketches.flow_by_month(_customer_states(s))


def _delivered(s: Sample) -> DataFrame:
    return sketches.delivered_by_state(s.fulfillment, s.star["dim_customers"])


@query
def delivery_percentiles_by_state(s: Sample) -> DataFrame:
    return sketches.delivery_percentiles(_delivered(s))


@query
def delivery_sketch_check(s: Sample) -> DataFrame:
    """Percentiles from stored sketches of days, held against all deliveries."""
    lake = s.fresh_lake("delivery-states")
    delivered = durable(_delivered(s), "delivered")
    even = F.col("purchase_date_key") % 2 == 0
    for name, days in (("even", even), ("odd", ~even)):
        sketches.add_states(lake, "delivery", sketches.daily_delivery(delivered.filter(days)), name)
    found = sketches.sketched_delivery(sketches.states(lake, "delivery"))
    return sketches.rank_errors(delivered, durable(found, "percentiles"))


@query
def profile_states(s: Sample) -> DataFrame:
    """Payments profiled in two halves whose states are merged."""
    columns = ["payment_type", "payment_installments", "payment_sequential"]
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    halves = [
        profile.profile_state(s.clean["order_payments"].filter(half == rest).select(*columns))
        for rest in (0, 1)
    ]
    merged = profile.merge_states(halves[0].unionByName(halves[1]))
    return profile.profile(merged).drop("median")


# ---- insights ----


@query
def revenue_by_period(s: Sample) -> DataFrame:
    return insights.revenue_by_period(s.sales)


@query
def revenue_by_geography(s: Sample) -> DataFrame:
    return insights.revenue_by_geography(s.customers)


@query
def delivery_by_month(s: Sample) -> DataFrame:
    return insights.delivery_by_month(s.fulfillment)


@query
def delivery_by_state(s: Sample) -> DataFrame:
    return insights.delivery_by_state(s.fulfillment, s.star["dim_customers"])


@query
def delivery_by_seller_state(s: Sample) -> DataFrame:
    return insights.delivery_by_seller_state(
        s.fulfillment, s.star["fact_sales"], s.star["dim_sellers"]
    )


@query
def review_trend(s: Sample) -> DataFrame:
    return insights.review_trend(s.fulfillment)


@query
def review_delay_correlation(s: Sample) -> DataFrame:
    return insights.review_delay_correlation(s.fulfillment)


@query
def product_extremes(s: Sample) -> DataFrame:
    return insights.product_extremes(s.products)


@query
def seller_ranking(s: Sample) -> DataFrame:
    summary = insights.seller_summary(
        s.star["fact_sales"], s.fulfillment, s.star["dim_sellers"]
    )
    return insights.seller_ranking(durable(summary, "sellers"))


@query
def customer_concentration(s: Sample) -> DataFrame:
    by = ("customer_state", "customer_city")
    places = durable(insights.place_summary(s.customers, *by), "places")
    return insights.concentration(places, *by)


@query
def state_concentration(s: Sample) -> DataFrame:
    places = durable(insights.place_summary(s.customers, "customer_state"), "places")
    return insights.concentration(places, "customer_state")


def _segments(s: Sample) -> DataFrame:
    values = durable(insights.customer_value(s.customers), "customer-value")
    return insights.rfm_segments(values)


@query
def rfm_segments(s: Sample) -> DataFrame:
    return _segments(s)


@query
def rfm_segment_sizes(s: Sample) -> DataFrame:
    return insights.segment_sizes(_segments(s))
