"""CSV loads, layered tables, catalog, command line and the file-drop stream."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from bazaarlake import cli
from bazaarlake.contracts import PLATINUM, RAW
from bazaarlake.operators.upsert import upsert
from bazaarlake.plans import pipeline, views
from bazaarlake.session import durable, passing, path_exists, scratch_path
from bazaarlake.sources import catalog
from bazaarlake.sources.csv_drop import (
    LoadError,
    full_load,
    incremental_load,
    read_csv,
    validate_layer,
)
from bazaarlake.sources.layers import clustered, with_period
from bazaarlake.sources.merge import merge_partitions
from bazaarlake.streaming.drops import start_upserts

SELLER_HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state"

FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 10:00:00,2018-01-10 00:00:00
o2,c2,delivered,2018-01-02 10:00:00,,,2018-01-20 10:00:00,2018-01-10 00:00:00
o3,c1,created,2018-02-01 10:00:00,,,,2018-02-10 00:00:00
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,1310, Sao Paulo,SP
c2,u2,04538,sao paulo,SP
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-03 00:00:00,100.0,20.0
o1,2,p2,s1,2018-01-03 00:00:00,150.0,15.0
o2,1,p1,s1,2018-01-03 00:00:00,89.9,10.0
o3,1,p2,s1,2018-02-03 00:00:00,150.0,15.0
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,200.0
o1,2,boleto,1,85.0
o2,1,debit_card,1,99.9
zz,1,boleto,1,1.0
""",
    "order_reviews": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"Great, ""really""
good",2018-01-06 00:00:00,2018-01-07 00:00:00
r2,o2,2,,,2018-01-21 00:00:00,2018-01-22 00:00:00
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,cama_mesa_banho,50,500,1,1000,20,20,20
p2,,45,400,2,800,15,15,15
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,1310,Sao Paulo,SP
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
1310,-23.5,-46.5,sao paulo,SP
1310,-23.7,-46.7,sao paulo,SP
""",
    "category_translation": """product_category_name,product_category_name_english
cama_mesa_banho,bed_bath_table
""",
}


def _drop(folder, files, pattern="{table}.csv"):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / pattern.format(table=name)).write_text(text)
    return str(folder)


@pytest.fixture
def loaded(lake, tmp_path):
    full_load(lake, _drop(tmp_path / "csv", FILES))
    return lake


def test_full_load_reports_rows_and_types(lake, tmp_path):
    report = full_load(lake, _drop(tmp_path / "csv", FILES)).collect()
    assert {r.table_name: (r.status, r.new_rows) for r in report} == {
        name: ("LOADED", n)
        for name, n in dict(
            orders=3, customers=2, order_items=4, order_payments=4, order_reviews=2,
            products=2, sellers=1, geolocation=2, category_translation=1,
        ).items()
    }
    for name, contract in RAW.items():
        stored = lake.read("bronze", name)
        assert [(f.name, f.dataType) for f in stored.schema] == [
            (f.name, f.dataType) for f in contract.schema
        ]
    zips = lake.read("bronze", "customers").select("customer_zip_code_prefix")
    assert {r[0] for r in zips.collect()} == {"1310", "04538"}


def test_quoted_field_spans_lines(loaded):
    text = loaded.read("bronze", "order_reviews").filter("review_id = 'r1'").first()
    assert text.review_comment_message == 'Great, "really"\ngood'


def test_failed_table_does_not_hide(lake, tmp_path):
    some = {k: v for k, v in FILES.items() if k != "sellers"}
    with pytest.raises(LoadError, match="sellers") as failure:
        full_load(lake, _drop(tmp_path / "csv", some))
    status = {r.table_name: r.status for r in failure.value.report.collect()}
    assert status.pop("sellers") == "FAILED" and set(status.values()) == {"LOADED"}


def test_files_are_split_unless_fields_may_span_lines(spark, tmp_path, rows):
    path = tmp_path / "s.csv"
    lines = [f"s{i},{i},a city with a rather long name {i},SP" for i in range(20_000)]
    path.write_text("\n".join([SELLER_HEADER, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128KB")
    try:
        whole = read_csv(spark, str(path), RAW["sellers"], multi_line=True)
        split = read_csv(spark, str(path), RAW["sellers"])
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert rows(whole) == rows(split)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_foreign_header_is_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("seller_city,seller_id,seller_state,seller_zip_code_prefix\na,b,c,1\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, str(path), RAW["sellers"]).collect()


def test_incremental_load(loaded, tmp_path):
    fresh = {
        "customers": FILES["customers"].splitlines()[0]
        + "\nc2,u2,04538,santos,SP\nc3,u3,04539,santos,SP\n",
        "sellers": FILES["sellers"].splitlines()[0] + "\n",
    }
    folder = _drop(tmp_path / "csv", fresh, "{table}_new.csv")
    for _ in range(2):  # the same file again changes nothing
        report = {r.table_name: r for r in incremental_load(loaded, folder).collect()}
        assert report["customers"].status == "MERGED"
        assert (report["customers"].new_rows, report["customers"].total_rows) == (2, 3)
        assert report["sellers"].status == "NO ROWS"
        assert report["orders"].status == "NO FILE"
        stored = loaded.read("bronze", "customers")
        assert {r.customer_id: r.customer_city for r in stored.collect()} == {
            "c1": " Sao Paulo",
            "c2": "santos",
            "c3": "santos",
        }


def test_incremental_load_creates_a_missing_table(lake, tmp_path):
    folder = _drop(tmp_path / "csv", {"sellers": FILES["sellers"]}, "{table}_new.csv")
    report = {r.table_name: r for r in incremental_load(lake, folder).collect()}
    assert report["sellers"].total_rows == 1
    assert lake.exists("bronze", "sellers") and not lake.exists("bronze", "orders")


def test_validation(loaded):
    tables = [*RAW, "absent"]
    got = validate_layer(loaded, "bronze", tables, {"orders": 3, "products": 9})
    status = {r.table_name: r.status for r in got.collect()}
    assert status.pop("orders") == "PASS"
    assert status.pop("products") == "FAIL"
    assert status.pop("absent") == "MISSING"
    assert set(status.values()) == {"EXISTS"}


def test_unknown_layer(lake):
    with pytest.raises(ValueError, match="layer"):
        lake.read("copper", "orders")


def test_write_modes_and_counts(lake, spark):
    assert lake.write(spark.range(5), "gold", "t") == 5
    assert lake.write(spark.range(3), "gold", "t") == 3
    assert lake.write(spark.range(2), "gold", "t", mode="append") == 2
    assert lake.read("gold", "t").count() == 5
    assert lake.write(spark.range(0), "gold", "empty") == 0


def test_dynamic_overwrite_keeps_other_partitions(lake, spark):
    both = spark.range(4).withColumn("p", (F.col("id") % 2).cast("int"))
    lake.write(both, "gold", "t", partition_by=["p"])
    one = spark.range(10, 11).withColumn("p", F.lit(0))
    lake.write(one, "gold", "t", partition_by=["p"], dynamic=True)
    assert sorted(lake.read("gold", "t").collect()) == [(1, 1), (3, 1), (10, 0)]


def test_merge_rewrites_only_partitions_with_new_rows(lake, spark, table):
    ddl = "k int, v string, p int"
    stored = table(ddl, (1, "old", 0), (2, "kept", 0), (3, "other", 1))
    lake.write(stored, "gold", "t", partition_by=["p"])

    def files():
        return {f for f in lake.read("gold", "t").inputFiles() if "/p=1/" in f}

    before = files()
    fresh = table(ddl, (1, "new", 0), (9, "added", 2))
    assert merge_partitions(lake, "gold", "t", fresh, ["k"], ["p"]) == 3
    assert sorted(lake.read("gold", "t").collect()) == [
        (1, "new", 0),
        (2, "kept", 0),
        (3, "other", 1),
        (9, "added", 2),
    ]
    assert files() == before


def test_passing_copy_goes_on_success_and_stays_on_failure(spark):
    with passing(spark.range(3), "t") as rows:
        (kept,) = {os.path.dirname(f) for f in rows.inputFiles()}
        assert path_exists(spark, kept)
    assert not path_exists(spark, kept)
    with pytest.raises(RuntimeError), passing(spark.range(3), "t") as rows:
        (kept,) = {os.path.dirname(f) for f in rows.inputFiles()}
        raise RuntimeError
    assert path_exists(spark, kept)


def test_durable_cuts_the_plan(spark):
    cut = durable(spark.range(3).filter("id > 0"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and sorted(cut.collect()) == [(1,), (2,)]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_pipeline_end_to_end(loaded, spark, rows):
    assert pipeline.build_silver(loaded)["order_payments"] == 3
    gold = pipeline.build_gold(loaded)
    assert gold == {
        "dim_products": 2, "dim_sellers": 1, "dim_customers": 2, "dim_date": 365,
        "fact_sales": 4, "fact_order_fulfillment": 3,
    }
    assert pipeline.build_platinum(loaded)["kpi_summary"] == 1
    marts = pipeline.mart_tables(loaded)
    for name, contract in PLATINUM.items():
        assert marts[name].dtypes == [
            (f.name, f.dataType.simpleString()) for f in contract.schema
        ]
    sales = marts["sales_summary_mart"].agg(F.sum("total_revenue")).first()[0]
    fact = loaded.read("gold", "fact_sales").agg(F.sum("total_item_value")).first()[0]
    assert round(sales, 2) == round(fact, 2) == 549.9
    kpi = marts["kpi_summary"].first()
    assert (kpi.late_delivery_rate_pct, kpi.repeat_customer_count) == (50.0, 1)
    located = loaded.read("gold", "dim_customers").filter("customer_id = 'c1'").first()
    assert (located.customer_lat, located.customer_city) == (-23.6, "sao paulo")

    month = loaded.read("gold", "fact_sales").filter("year = 2018 AND month = 2")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and month.count() == 1

    database = f"t{uuid.uuid4().hex}"
    catalog.create_database(spark, database, f"{loaded.root}/db")
    catalog.register(loaded, database)
    catalog.register(loaded, database)  # again: updates
    assert set(views.create_views(spark, database)) == set(views.VIEWS)
    listed = catalog.list_tables(spark, database)
    assert listed.count() == sum(len(c.columns) for c in PLATINUM.values())
    tiers = spark.table(f"{database}.vw_customer_tiers")
    assert tiers.agg(F.sum("customer_count")).first()[0] == 2
    catalog.drop_table(spark, database, "kpi_summary")
    assert path_exists(spark, loaded.path("platinum", "kpi_summary"))
    catalog.drop_database(spark, database)
    assert not spark.catalog.databaseExists(database)

    views.create_temp_views(spark, marts)
    inline = views.view_query(spark, "vw_customer_tiers", marts)
    assert rows(spark.table("vw_customer_tiers")) == rows(inline)


def test_clustered_files_cover_narrow_ranges(spark):
    fact = with_period(
        spark.range(1000).select(
            (20180100 + F.col("id") % 28 + 1).cast("int").alias("purchase_date_key"),
            "id",
        )
    )
    laid = clustered(fact, ["year", "month"], ["purchase_date_key"])
    spans = (
        laid.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("purchase_date_key").alias("lo"), F.max("purchase_date_key").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_command_line(spark, tmp_path, capsys):
    root, source = str(tmp_path / "lake"), _drop(tmp_path / "csv", FILES)

    def run(*words):
        return cli.main(["--root", root, *words], spark=spark)

    assert run("ingest", "--mode", "full_load", "--source", source) == 0
    assert run("ingest", "--mode", "incremental", "--source", source) == 0
    assert run("validate", "--expect", "orders=3") == 0
    assert run("validate", "--expect", "orders=4") == 1
    assert run("silver") == 0
    assert run("gold", "--table", "fact_sales") == 0
    assert "fact_sales: 4 rows" in capsys.readouterr().out
    assert run("gold") == run("platinum") == 0
    name = f"t{uuid.uuid4().hex}"
    assert run("catalog", "--database", name, "--views") == 0
    assert run("catalog", "--database", name, "--action", "list") == 0
    assert "revenue_day_growth_pct" in capsys.readouterr().out
    assert run("catalog", "--database", name, "--action", "delete") == 0
    missing = str(tmp_path / "nowhere")
    assert run("ingest", "--mode", "full_load", "--source", missing) == 1


# ---- stream ----


def _write(folder, name, *lines):
    """Put a finished file into the drop folder in one step."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([SELLER_HEADER, *lines]) + "\n")


def _run_stream(lake, folder, tmp_path):
    query = start_upserts(lake, str(folder), RAW["sellers"], str(tmp_path / "progress"))
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_stream_reads_each_file_once_and_survives_restart(lake, tmp_path):
    drops = tmp_path / "drops"
    _write(drops, "a.csv", "s1,1310,x,SP", "s2,1311,x,SP")
    assert _run_stream(lake, drops, tmp_path) == 2
    _write(drops, "b.csv", "s2,1311,moved,SP", "s3,1312,x,SP")
    assert _run_stream(lake, drops, tmp_path) == 2
    assert _run_stream(lake, drops, tmp_path) == 0
    stored = lake.read("bronze", "sellers").collect()
    assert {r.seller_id: r.seller_city for r in stored} == {
        "s1": "x",
        "s2": "moved",
        "s3": "x",
    }


def test_stream_takes_the_later_of_two_waiting_files(lake, tmp_path):
    drops = tmp_path / "drops"
    _write(drops, "a.csv", "s1,1310,first,SP")
    _write(drops, "b.csv", "s1,1310,second,SP")
    os.utime(drops / "a.csv", (1_000_000, 1_000_000))
    _run_stream(lake, drops, tmp_path)
    assert [r.seller_city for r in lake.read("bronze", "sellers").collect()] == ["second"]


def test_stream_refuses_a_file_that_repeats_an_earlier_key(lake, tmp_path):
    drops = tmp_path / "drops"
    _write(drops, "a.csv", "s1,1310,first,SP")
    _write(drops, "b.csv", "s1,1310,x,SP", "s1,1310,y,SP")
    os.utime(drops / "a.csv", (1_000_000, 1_000_000))
    with pytest.raises(Exception, match="earlier file"):
        _run_stream(lake, drops, tmp_path)


def test_stream_sets_rows_without_key_aside(lake, tmp_path):
    drops = tmp_path / "drops"
    _write(drops, "a.csv", "s1,1310,x,SP", ",1311,lost,SP")
    _run_stream(lake, drops, tmp_path)
    assert lake.read("bronze", "sellers").count() == 1
    rejected = lake.read("bronze", "sellers_rejects")
    assert [r.seller_city for r in rejected.collect()] == ["lost"]


def test_stream_equals_batch(lake, tmp_path, spark, rows):
    drops = tmp_path / "drops"
    _write(drops, "a.csv", "s1,1310,x,SP", "s2,1311,x,SP")
    _write(drops, "b.csv", "s2,1311,moved,SP")
    os.utime(drops / "a.csv", (1_000_000, 1_000_000))
    _run_stream(lake, drops, tmp_path)
    first, second = (
        read_csv(spark, str(drops / n), RAW["sellers"]) for n in ("a.csv", "b.csv")
    )
    assert rows(lake.read("bronze", "sellers")) == rows(
        upsert(first, second, ["seller_id"])
    )
