"""Nothing is lost without a word: loads, the stream, results, storage."""

import pytest
from pyspark.sql import functions as F

from bazaarlake.contracts import RAW
from bazaarlake.plans import insights, marts
from bazaarlake.plans.views import _half_up
from bazaarlake.session import shared_dir
from bazaarlake.sources.csv_drop import LoadError, full_load, incremental_load
from bazaarlake.streaming.drops import start_upserts

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
SELLERS = {"sellers": RAW["sellers"]}
ITEMS = {"order_items": RAW["order_items"]}


def _write(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_full_load_keeps_unreadable_lines(lake, tmp_path):
    header = ",".join(RAW["order_items"].columns)
    good = "o1,1,p1,s1,2017-01-01 00:00:00,10.5,1.5"
    bad = ["o2,abc,p1,s1,2017-01-01 00:00:00,10.5,1.5", "o3,1,p1,s1", "o4,1,p1,s1,2017-01-01 00:00:00,\"12,50\",1"]
    _write(tmp_path / "in", "order_items.csv", header, good, *bad)
    report = full_load(lake, str(tmp_path / "in"), tables=ITEMS).first()
    assert (report.new_rows, report.error) == (4, "3 raw rows kept as rejects")
    rejects = lake.read("bronze", "order_items_rejects")
    assert {r._corrupt_record for r in rejects.collect()} == set(bad)
    with pytest.raises(LoadError):
        full_load(lake, str(tmp_path / "in"), tables=ITEMS, strict=True)


def test_increment_again_adds_nothing(lake, tmp_path):
    _write(tmp_path / "in", "sellers_new.csv", HEADER, "s1,1310,x,SP", ",1311,lost,SP")
    for _ in range(2):
        report = incremental_load(lake, str(tmp_path / "in"), tables=SELLERS).first()
        assert (report.total_rows, report.error) == (1, "1 raw rows kept as rejects")
        rejects = lake.read("bronze", "sellers_rejects")
        assert [(r.seller_city, r.reason) for r in rejects.collect()] == [("lost", "no key")]


def test_streams_keep_their_own_rejects(lake, tmp_path):
    for name in ("a", "b"):
        _write(tmp_path / name, "x.csv", HEADER, f",1311,{name},SP", "s1,1")
        start_upserts(lake, str(tmp_path / name), RAW["sellers"], str(tmp_path / f"c{name}")).awaitTermination()
    got = lake.read("bronze", "sellers_rejects").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in got} == {"no key": 2, "unreadable": 2}


def test_lines_without_customer_stay(table):
    lines = table("order_id string, customer_id string", ("o1", "c1"), ("o2", "gone"), ("o3", None))
    people = table("customer_id string, customer_unique_id string", ("c1", "p1"))
    assert marts.with_person(lines, people).count() == 3


def test_place_without_revenue_stays(table):
    places = table("place string, customer_count bigint, revenue_cents bigint", ("a", 1, 100), ("b", 3, None))
    got = {r.place: r for r in insights.concentration(places, "place").collect()}
    assert got["b"].customer_share_pct == 75.0 and got["b"].revenue_rank is None
    assert got["a"].cumulative_revenue_pct == 100.0


@pytest.mark.parametrize("num, want", [(-749, -75), (-745, -75), (-5, -1), (-4, 0), (745, 75), (0, 0)])
def test_view_means_round_away_from_zero(spark, num, want):
    sql = _half_up(f"SUM({num})", "COUNT(*) * 10")
    assert spark.sql(f"SELECT {sql} AS x").first().x == want


def test_stored_fact_by_month(table):
    fact = table(
        "purchase_date_key int, shipping_duration_days int, delivery_delay_days int, "
        "is_late_delivery int, year int, month int",
        (20170105, 3, 0, 0, 2017, 1),
    )
    columns = insights.delivery_by_month(fact).columns
    assert columns[:2] == ["year", "month"]


def test_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_half_written_table_does_not_exist(lake, spark):
    spark.range(3).write.parquet(lake.path("bronze", "t"))
    assert lake.exists("bronze", "t")
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        lake.path("bronze", "u")
    )
    assert not lake.exists("bronze", "u")


def test_raw_zip_shapes(table):
    from bazaarlake.operators.quality import zip_ranges

    df = table("z string", ("01310",), ("123456",), ("1310",), (None,), ("99999",))
    got = {r.zip_shape: r.row_count for r in zip_ranges(df, "z").select(F.col("*")).collect()}
    assert got == {"leading zero": 1, "wrong length": 2, "missing": 1, "plain": 1}
