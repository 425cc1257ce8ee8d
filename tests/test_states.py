"""Sketch states, percentiles, profiles, clustering, as-of joins, reconciliation, buckets."""

import bisect
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarlake.contracts import RAW
from bazaarlake.functions import percentiles, ranking
from bazaarlake.operators import profile, reconcile
from bazaarlake.operators.asof import asof_join
from bazaarlake.operators.upsert import DUPLICATE_SOURCE
from bazaarlake.plans import sketches
from bazaarlake.sources import zorder
from bazaarlake.sources.bucketed import BucketedTable
from bazaarlake.sources.csv_drop import read_csv
from bazaarlake.sources.csv_records import read_records
from bazaarlake.sources.merge import merge
from bazaarlake.streaming.drops import start_upserts

# ---- ranks over sparse values ----


def test_sparse_values_do_not_meet_in_one_window(table):
    """Values 10 million apart: fixed ranges would be one per value."""
    df = table("v bigint, w bigint", *[(i * 10_000_000, 1) for i in range(3000)])
    got = ranking.value_ranks(df, "v", total="w", width=1000).collect()
    assert {(r.v, r.rank_no, r.running_total) for r in got} == {
        (i * 10_000_000, i + 1, i + 1) for i in range(3000)
    }
    groups = df.select(F.floor(F.floor(F.col("v") / ranking.RANGE_WIDTH) / ranking.RANGE_WIDTH)).distinct()
    assert groups.count() == 1  # the rows of the one window over all groups


# ---- percentiles ----


def nearest_rank(values, share):
    values = sorted(values)
    return values[max(0, -(-share * len(values) // 100) - 1)]


def test_exact_percentiles_are_nearest_ranks(table):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, rng.randrange(40)])) for _ in range(500)] + [("c", 7), ("d", None)]
    got = percentiles.exact_percentiles(table("g string, v int", *rows), ["g"], "v", (1, 50, 90, 99, 100))
    for r in got.collect():
        values = [v for g, v in rows if g == r.g and v is not None]
        assert r.values_n == len(values)
        assert [r[f"p{s}"] for s in (1, 50, 90, 99, 100)] == [nearest_rank(values, s) for s in (1, 50, 90, 99, 100)]
    assert {r.g for r in got.collect()} == {"a", "b", "c"}


def test_merged_sketches_keep_their_rank_error(table):
    rng = random.Random(2)
    values = [int(rng.expovariate(0.001)) for _ in range(20_000)]
    df = table("lot int, v int", *[(i % 30, v) for i, v in enumerate(values)])
    states = df.groupBy("lot").agg(percentiles.sketch_of("v").alias("s"))
    whole = states.agg(percentiles.merged("s").alias("s"))
    got = whole.select(*percentiles.sketched_percentiles("s", (50, 90, 99))).first()
    values.sort()
    for share in (50, 90, 99):
        low, high = bisect.bisect_left(values, got[f"p{share}"]), bisect.bisect_right(values, got[f"p{share}"])
        error = percentiles.RANK_ERROR * len(values)
        assert low - error <= share / 100 * len(values) <= high + error


def test_rank_errors_show(table):
    delivered = table("customer_state string, purchase_date_key int, shipping_duration_days int", *[("s", 1, i) for i in range(100)])
    wrong = table("customer_state string, deliveries bigint, p50 bigint, p90 bigint, p99 bigint", ("s", 100, 49, 80, 99))
    assert sketches.rank_errors(delivered, wrong).first()[2:] == (True, False, True)


# ---- distinct counts ----


def test_distinct_counts_of_any_period_from_stored_days(lake, table):
    rng = random.Random(3)
    rows = [(20180000 + m * 100 + d, f"c{rng.randrange(90)}") for m in range(1, 8) for d in range(1, 6) for _ in range(8)]
    rows += [(20180105, None), (None, "c1"), (20191231, "new")]
    df = table("purchase_date_key int, customer_id string", *rows)
    for name, half in (("a", "purchase_date_key < 20180400"), ("b", "purchase_date_key >= 20180400"), ("c", "purchase_date_key > 20180500")):
        sketches.add_states(lake, "customers", sketches.daily_customers(df.filter(half)), name)
    sketches.add_states(lake, "customers", sketches.daily_customers(df.filter("purchase_date_key >= 20180400")), "b")
    states = sketches.states(lake, "customers")

    def of(low, high):
        return {c for k, c in rows if k and c and low <= k <= high}

    by = {(r.level, r.year, r.quarter, r.month): r.customers for r in sketches.distinct_by_period(states).collect()}
    assert by["all", None, None, None] == len(of(0, 10**9))
    assert by["quarter", 2018, 2, None] == len(of(20180400, 20180700))
    assert by["month", 2018, 3, 7] == len(of(20180700, 20180800))
    flow = {(r.year, r.month): r[2:] for r in sketches.flow_by_month(states).collect()}
    march, before = of(20180300, 20180400), of(20180200, 20180300)
    assert flow[2018, 3] == (len(march), len(march & before), len(march - of(0, 20180300)))
    assert flow[2019, 12] == (1, 0, 1)


def test_distinct_counts_beyond_the_sketch_stay_within_their_error(spark):
    df = spark.range(60_000).selectExpr("CAST(20180101 + id % 9 AS INT) AS purchase_date_key", "CAST(id % 30000 AS STRING) AS customer_id")
    states = sketches.daily_customers(df, log_k=12)
    got = {r.level: r.customers for r in sketches.distinct_by_period(states, log_k=12).filter("level = 'all'").collect()}
    assert abs(got["all"] / 30_000 - 1) < 4 / 64  # four standard errors of 1 / sqrt(2 ** 12)


# ---- profiles ----


def test_profiles_of_halves_make_the_profile_of_all(table):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "é"]), rng.choice([None, rng.randrange(9)]), rng.random(), None) for _ in range(400)]
    df = table("t string, `n.o` int, d double, `void` string", *rows)
    halves = [profile.profile_state(df.filter(F.col("d") < 0.4)), profile.profile_state(df.filter(F.col("d") >= 0.4))]
    merged = profile.profile(profile.merge_states(halves[0].unionByName(halves[1])))
    whole = profile.profile(profile.profile_state(df))
    exact = ["column_name", "data_type", "row_count", "nulls", "distinct_values", "least", "largest"]
    assert sorted(map(tuple, merged.select(*exact).collect())) == sorted(map(tuple, whole.select(*exact).collect()))
    by = {r.column_name: r for r in merged.collect()}
    texts = Counter(r[0] for r in rows if r[0] is not None)
    assert (by["t"].top, by["t"].top_rows) == min(texts.items(), key=lambda x: (-x[1], x[0]))
    assert by["t"].nulls == sum(r[0] is None for r in rows) and by["t"].median is None
    assert (by["void"].distinct_values, by["void"].least, by["void"].top) == (0, None, None)
    assert abs(by["d"].median - 0.5) < 0.1 and by["n.o"].least == "0.0"


# ---- clustering ----


def test_z_order_serves_a_filter_on_either_column(lake, spark):
    df = spark.range(20_000).selectExpr("CAST(id * 7919 % 500 AS STRING) AS a", "CAST(id % 365 AS INT) AS b", "id")
    lake.write(zorder.z_ordered(df, ["a", "b"], files=36), "gold", "z")
    stored = lake.read("gold", "z")
    for column, probes in (("a", ["17", "400", "99"]), ("b", [0, 180, 364])):
        for r in zorder.files_met(stored, column, probes).collect():
            assert r.files * 3 < r.all_files == 36
    assert stored.exceptAll(df).count() == 0 and stored.count() == 20_000


def test_gold_facts_on_a_curve(lake, spark):
    from bazaarlake.operators.cleaning import clean_all
    from bazaarlake.plans.pipeline import build_gold
    from bazaarlake.sources.star_sample import raw_tables

    lake.write_all(clean_all(raw_tables(spark, "/root/testdata/sf0.001")), "silver")
    rows = build_gold(lake, ["fact_sales", "fact_order_fulfillment"], z_order=True)
    assert rows == {name: lake.read("gold", name).count() for name in rows} and min(rows.values()) > 1000


def test_bucket_numbers_and_bits(table):
    cuts = [2, 5, 5 + 1, 9]
    df = table("v int", *[(i,) for i in range(12)], (None,))
    got = df.select("v", zorder.bucket_number(F.col("v"), cuts).alias("n")).collect()
    assert all(r.n == bisect.bisect_right(cuts, r.v) for r in got if r.v is not None)
    key = table("x int, y int", (0b101, 0b010)).select(zorder.interleaved([F.col("x"), F.col("y")], 3)).first()[0]
    assert key == 0b100110


def test_bucket_numbers_by_steps(table):
    cuts = [[2, 5, 6, 9], ["b", "d"]]
    df = table("v int, t string", *[(i, "abcde"[i % 5]) for i in range(12)], (None, None))
    found = zorder.with_bucket_numbers(df, ["v", "t"], cuts, 3)
    for r in found.collect():
        wanted = [0 if x is None else bisect.bisect_right(c, x) for x, c in zip((r.v, r.t), cuts)]
        assert [r["_bucket0"], r["_bucket1"]] == wanted
    # A cut stands in the plan a few times, not once for each way through the search.
    many = zorder.with_bucket_numbers(df, ["v"], [list(range(100, 355))], 8)
    assert many._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") <= 8


def test_z_order_of_nulls_one_value_and_nothing(table):
    df = table("a int, b string", (None, None), (1, None), (1, "x"), (1, "x"))
    assert sorted(map(str, zorder.z_ordered(df, ["a", "b"]).collect())) == sorted(map(str, df.collect()))
    assert zorder.z_ordered(df.filter("a > 9"), ["a", "b"]).collect() == []


# ---- as-of ----


@pytest.mark.parametrize("strictly", [False, True])
@pytest.mark.parametrize("period", [1, 7, 1000])
def test_asof_join_against_brute_force(table, strictly, period):
    rng = random.Random(period)
    keys = ["hot"] * 8 + ["b", "c", None]
    left = [(i, rng.choice(keys), rng.choice([None, rng.randrange(-20, 60)])) for i in range(200)]
    past = [(rng.choice(["hot"] * 5 + ["b", None]), rng.choice([None, rng.randrange(60)]), rng.choice([None, rng.randrange(5)]), "x") for _ in range(60)]
    got = asof_join(
        table("i int, k string, t int", *left),
        table("key string, at int, price int, tag string", *past).withColumnRenamed("key", "k"),
        ["k"], "t", "at", ["price", "at"], period=period, strictly=strictly,
    )

    def match(k, t):
        fit = [
            (at, -1 if price is None else price)
            for key, at, price, _ in past
            if k is not None and t is not None and key == k and at is not None and (at < t if strictly else at <= t)
        ]
        return max(fit, default=None)

    for r in got.collect():
        found = match(r.k, r.t)
        assert (r.at, r.price) == ((found[0], None if found[1] < 0 else found[1]) if found else (None, None))
    assert got.count() == 200


def test_asof_join_without_history_and_with_clashing_names(table):
    left, none = table("k string, t int", ("a", 1)), table("k string, at int, p int")
    assert asof_join(left, none, ["k"], "t", "at", ["p"]).collect() == [("a", 1, None)]
    with pytest.raises(ValueError, match="p"):
        asof_join(left.withColumn("p", F.lit(1)), none, ["k"], "t", "at", ["p"])


# ---- reconciliation ----


def test_differences_are_found_and_other_buckets_not_read(lake, table):
    rows = [(str(i), i % 3, None if i % 5 else "x") for i in range(500)] + [(None, 1, "n"), ("7", 9, "again")]
    ddl = "k string, a int, b string"
    changed = [r for r in rows if r[0] != "3"] + [("new", 1, None)]
    changed[10] = (changed[10][0], 77, changed[10][2])
    changed[20] = (changed[20][0], None, changed[20][2])
    for name, some in (("old", rows), ("new", changed[::-1])):
        lake.write(reconcile.with_bucket(table(ddl, *some), ["k"], 32), "silver", name, partition_by=[reconcile.BUCKET])
    old, new = lake.read("silver", "old"), lake.read("silver", "new")
    got = reconcile.table_difference(old, new, ["k"])
    assert {tuple(r) for r in got.collect()} == {
        ("3", "missing"), ("new", "extra"), (changed[10][0], "changed"), (changed[20][0], "changed"),
    }
    assert 1 <= len(reconcile.differing_buckets(old, new)) <= 4
    scans = [line for line in got._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert any(f"{reconcile.BUCKET}" in line.split("PartitionFilters")[1] for line in scans)
    assert reconcile.table_difference(old, old, ["k"]).collect() == []


def test_swapped_values_of_two_columns_differ(table):
    a = reconcile.with_bucket(table("k int, a int, b int", (1, 2, 3), (2, None, 5)), ["k"], 4)
    b = reconcile.with_bucket(table("k int, a int, b int", (1, 3, 2), (2, 5, None)), ["k"], 4)
    assert {r.status for r in reconcile.table_difference(a, b, ["k"]).collect()} == {"changed"}


# ---- bucketed bronze, one write per merge ----

CUSTOMERS = RAW["customers"]


def customer(i, city="old"):
    return (str(i), f"u{i}", "1", city, "s")


def files_of(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


@pytest.fixture
def bucketed(lake, table):
    name = "db_" + os.path.basename(os.path.dirname(lake.root)).replace("-", "_")
    made = BucketedTable(lake, CUSTOMERS, name, buckets=8)
    made.create(table(CUSTOMERS.ddl, *[customer(i) for i in range(200)]))
    yield made
    lake.spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_merge_touches_only_its_buckets(bucketed, table, lake, rows):
    place = lake.path("bronze", "customers_bucketed")
    before = files_of(place)
    assert bucketed.merge(table(CUSTOMERS.ddl, customer(5, "new"), customer(900, "new"))) == 201
    after = files_of(place)
    touched = {f.split("/")[0] for f in set(before) ^ set(after)}
    assert 1 <= len(touched) <= 2
    kept = {f: t for f, t in before.items() if f.split("/")[0] not in touched}
    assert kept and kept.items() <= after.items()
    want = [customer(i, "new" if i == 5 else "old") for i in range(200)] + [customer(900, "new")]
    assert rows(bucketed.read()) == sorted(want, key=str)
    assert bucketed.merge(table(CUSTOMERS.ddl)) == 201
    assert lake.spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_the_stored_rows_meet_no_exchange(bucketed, table, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = bucketed.merged(table(CUSTOMERS.ddl, customer(5, "new")))._jdf.queryExecution().executedPlan().toString()
    target = plan.split("SortMergeJoin", 1)[1].split("Exchange")[0]
    assert "Scan parquet" in target and "Bucketed: true" in target


def test_two_source_rows_for_a_stored_key_are_an_error(bucketed, lake, table):
    twice = table(CUSTOMERS.ddl, customer(5, "a"), customer(5, "b"))
    with pytest.raises(Exception, match=DUPLICATE_SOURCE):
        bucketed.merge(twice)
    lake.write(table(CUSTOMERS.ddl, customer(5)), "bronze", "customers")
    with pytest.raises(Exception, match=DUPLICATE_SOURCE):
        merge(lake, CUSTOMERS, twice)
    assert lake.read("bronze", "customers").count() == 1  # as before


def test_a_merge_writes_once_and_leaves_nothing_beside(lake, table, rows):
    lake.write(table(CUSTOMERS.ddl, customer(1), customer(2)), "bronze", "customers")
    assert merge(lake, CUSTOMERS, table(CUSTOMERS.ddl, customer(2, "new"), customer(3))) == 3
    assert rows(lake.read("bronze", "customers")) == [customer(1), customer(2, "new"), customer(3)]
    assert os.listdir(f"{lake.root}/bronze") == ["customers"]


def test_a_stream_into_buckets(bucketed, lake, table, rows):
    drops = f"{lake.root}/drops"
    table(CUSTOMERS.ddl, customer(5, "new"), customer(300)).coalesce(1).write.csv(drops, header=True)
    start_upserts(
        lake, drops, CUSTOMERS, f"{lake.root}/check", merge_with=lambda _l, _c, fresh: bucketed.merge(fresh)
    ).awaitTermination()
    assert bucketed.read().filter("customer_city = 'new'").count() == 1
    assert bucketed.read().count() == 201


# ---- records over lines, read by many tasks ----

REVIEWS = RAW["order_reviews"]


def review(i, text):
    return (f"r{i}", str(i), i % 5 + 1, 'a "title"', text, None, None)


@pytest.mark.parametrize("block", ["300", "1m"])
def test_records_over_lines_and_blocks(lake, spark, rows, settings, block):
    rng = random.Random(5)
    bits = ["word", "\n", ",", '"', "\n\n", "é", 'x"y"z', " "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 30))) + "." for _ in range(200)]
    texts[50] = "line\n" * 300 + "end"  # longer than several blocks
    made = spark.createDataFrame([review(i, t) for i, t in enumerate(texts)], REVIEWS.schema)
    for part in (0, 1):
        made.filter(F.col("order_id").cast("int") % 2 == part).coalesce(1).write.mode("append").csv(
            f"{lake.root}/csv", header=True, escape='"'
        )
    settings(files__maxPartitionBytes=block, files__openCostInBytes="1")
    with read_records(spark, f"{lake.root}/csv", REVIEWS) as got:
        assert got.count() == 200
        assert rows(got) == rows(read_csv(spark, f"{lake.root}/csv", REVIEWS, multi_line=True))


def test_records_that_do_not_fit_and_a_wrong_header(lake, spark):
    os.makedirs(f"{lake.root}/csv")
    with open(f"{lake.root}/csv/a.csv", "w") as out:
        out.write(",".join(REVIEWS.columns) + '\nr1,1,high,"t\n1",m,,\nr2,2,5,t,m,,\n')
    with read_records(spark, f"{lake.root}/csv", REVIEWS, corrupt=True) as got:
        found = {r.review_id: r for r in got.collect()}
    assert found["r1"].review_score is None and found["r1"]._corrupt_record.startswith("r1,1,high")
    assert found["r2"].review_score == 5 and found["r2"]._corrupt_record is None
    with read_records(spark, f"{lake.root}/csv", RAW["sellers"]) as got, pytest.raises(Exception, match="header"):
        got.collect()
