"""States kept up from changes against marts that are rebuilt."""

import random
import zlib
from collections import Counter
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import bits as bits_filter
from bazaarlake.plans import gold, marts, queries, upkeep
from bazaarlake.streaming import lots
from bazaarlake.streaming.daily_mart import HEADS, OrderLots, OrderParts, daily_mart, days_of, start_daily_mart

ORDERS = """order_id string, customer_id string, order_status string,
    order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
    order_delivered_carrier_date timestamp_ntz,
    order_delivered_customer_date timestamp_ntz,
    order_estimated_delivery_date timestamp_ntz"""
ITEMS = """order_id string, order_item_id int, product_id string, seller_id string,
    shipping_limit_date timestamp_ntz, price double, freight_value double"""
PAYMENTS = """order_id string, payment_sequential int, payment_type string,
    payment_installments int, payment_value double"""
REVIEWS = """review_id string, order_id string, review_score int,
    review_comment_title string, review_comment_message string,
    review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"""
DDL = {"orders": ORDERS, "order_items": ITEMS, "order_payments": PAYMENTS, "order_reviews": REVIEWS}
KEYS = {"orders": 1, "order_items": 2, "order_payments": 2, "order_reviews": 1}
SAMPLE = "/root/testdata/sf0.001"
START = datetime(2018, 1, 1)


def day(n):
    return START + timedelta(days=n)


def order(key, customer, bought, delivered=None):
    return (key, customer, "x", bought, None, None, delivered, day(20))


def line(key, n, product, price, seller="s1", freight=0.5):
    return (key, n, product, seller, None, price, freight)


def paid(key, n, value):
    return (key, n, "boleto", 1, value)


def review(key, of, score):
    return (key, of, score, "t", "m", None, None)


@pytest.fixture
def dims(table):
    return {
        "dim_date": gold.dim_date(
            table("first_day date, last_day date", (START.date(), day(364).date()))
        ),
        "dim_customers": table(
            """customer_id string, customer_unique_id string, customer_zip_code_prefix string,
               customer_city string, customer_state string, geo_lat double, geo_lng double""",
            *[(f"c{i}", f"u{i}", "1", "city", "s", 1.0, 1.0) for i in range(9)],
        ),
        "dim_products": table(
            """product_id string, product_category_en string, product_weight_g double,
               product_length_cm double, product_height_cm double, product_width_cm double""",
            *[(f"p{i}", "c", 1.0, 1.0, 1.0, 1.0) for i in range(9)],
        ),
    }


def upserted(rows, changes):
    out = {}
    for name, n in KEYS.items():
        fresh = changes.get(name, [])
        keys = {r[:n] for r in fresh}
        out[name] = [r for r in rows[name] if r[:n] not in keys] + fresh
    return out


def frames(table, rows):
    return {name: table(DDL[name], *rows[name]) for name in rows}


def facts(tables):
    return (
        gold.fact_sales(tables["order_items"], tables["orders"], tables["order_payments"]),
        gold.fact_order_fulfillment(tables["orders"], tables["order_reviews"]),
    )


def rebuilt(tables, dims):
    sales, steps = facts(tables)
    return marts.all_marts({**dims, "fact_sales": sales, "fact_order_fulfillment": steps})


def assert_same(kept, wanted, rows):
    for name in wanted:
        assert kept[name].schema.simpleString() == wanted[name].schema.simpleString()
        assert rows(kept[name]) == rows(wanted[name]), name


FIRST = {
    "orders": [order("1", "c1", day(0), day(5)), order("2", "c1", day(3)), order("3", "c2", day(3), day(30))],
    "order_items": [line("1", 1, "p1", 10.0), line("1", 2, "p1", 5.0), line("2", 1, "p2", 7.0), line("3", 1, "p1", None)],
    "order_payments": [paid("1", 1, 16.0), paid("3", 1, 2.0), paid("3", 2, 1.5)],
    "order_reviews": [review("r1", "1", 5), review("r3", "3", 2), review("r4", "3", None)],
}


@pytest.mark.parametrize(
    "change_sets",
    [
        [
            {"orders": [order("1", "c1", day(9), day(5))]},  # to another day
            {"orders": [order("2", "c3", day(1))]},  # the customer's last day falls back
            {"orders": [order("3", "c2", None)]},  # no day at all
            {"order_items": [line("1", 2, "p3", 6.0, "s2"), line("2", 2, "p2", 1.0)]},
        ],
        [
            {"order_payments": [paid("2", 1, 7.5), paid("1", 1, None)]},
            {"order_reviews": [review("r1", "2", 1)]},  # to another order
            {"orders": [order("4", "c4", day(2), day(3))], "order_items": [line("4", 1, "p4", 2.0)]},
            {"order_items": [line("9", 1, "p1", 1.0)]},  # its order is not there
        ],
    ],
)
def test_changes_are_a_rebuild(lake, table, rows, dims, change_sets):
    before, kept, now = frames(table, FIRST), upkeep.Upkeep(lake), FIRST
    kept.build(*facts(before))
    for n, changes in enumerate(change_sets):
        kept.apply(frames(table, now), {k: table(DDL[k], *r) for k, r in changes.items()}, str(n))
        now = upserted(now, changes)
    assert_same(kept.marts(dims), rebuilt(frames(table, now), dims), rows)


def test_many_changes_repeated_and_compacted(lake, table, rows, dims):
    rng = random.Random(4)

    def some(n):
        keys = [str(rng.randrange(30)) for _ in range(n)]
        made = {
            "orders": [order(k, f"c{rng.randrange(5)}", day(rng.randrange(9)), rng.choice([None, day(12)])) for k in keys],
            "order_items": [line(k, rng.randrange(3), f"p{rng.randrange(4)}", rng.randrange(900) / 100, f"s{rng.randrange(3)}") for k in keys],
            "order_payments": [paid(k, rng.randrange(2), rng.randrange(900) / 100) for k in keys],
            "order_reviews": [review(f"r{k}", rng.choice(keys), rng.randrange(1, 6)) for k in keys],
        }
        return {name: list({r[: KEYS[name]]: r for r in t}.values()) for name, t in made.items()}

    state = some(40)
    kept = upkeep.Upkeep(lake)
    kept.build(*facts(frames(table, state)))
    for n in range(2):
        changes = some(8)
        fresh = {name: table(DDL[name], *r) for name, r in changes.items()}
        for _ in range(1 + n % 2):  # a repeated change set replaces its own contributions
            kept.apply(frames(table, state), fresh, str(n))
        state = upserted(state, changes)
    wanted = rebuilt(frames(table, state), dims)
    assert_same(kept.marts(dims), wanted, rows)
    for name in upkeep.STATES:
        kept.compact(name)
        assert kept.parts(name).select("change_set").distinct().count() == 1
    assert_same(kept.marts(dims), wanted, rows)


def test_untouched_orders_are_not_shuffled(lake, table):
    many = {name: [] for name in DDL}
    many["orders"] = [order(str(i), "c1", day(i % 9)) for i in range(2000)]
    many["order_items"] = [line(str(i), 1, "p1", 1.0) for i in range(2000)]
    before = {}
    for name, df in frames(table, many).items():
        df.write.parquet(f"{lake.root}/{name}")
        before[name] = lake.spark.read.parquet(f"{lake.root}/{name}")
    table("order_id string", ("7",)).write.parquet(f"{lake.root}/touched")
    touched = lake.spark.read.parquet(f"{lake.root}/touched")  # as apply() passes it
    lines, _ = upkeep.signed_changes(before, before, touched)
    assert lines.count() == 2
    plan = lines._jdf.queryExecution().executedPlan().toString()
    semi = [row for row in plan.split("Initial Plan")[0].splitlines() if "LeftSemi" in row]
    assert semi and all("BroadcastHashJoin" in row for row in semi)


def test_too_many_touched_orders_to_broadcast_are_filtered_first(lake, table, rows, settings, monkeypatch):
    monkeypatch.setattr(bits_filter, "WORDS", 64)
    ids = [f"{i:0>200}" for i in range(4000)]
    many = {name: [] for name in DDL}
    many["order_items"] = [line(i, 1, "p1", 1.0) for i in [*ids, None]]
    before = frames(table, many)

    def stored(name, df):
        df.write.parquet(f"{lake.root}/{name}")
        return lake.spark.read.parquet(f"{lake.root}/{name}")

    touched = stored("touched", table("order_id string", *[(i,) for i in ids[::4]]))
    bits = stored("bits", bits_filter.bits_of(touched, "order_id"))
    settings(autoBroadcastJoinThreshold="300")
    found = upkeep._of(before, touched, bits)["order_items"]
    assert sorted(r.order_id for r in found.collect()) == ids[::4]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    semi = [row for row in plan.splitlines() if "LeftSemi" in row]
    # From the top: the touched ids meet a shuffle, below it the bits do not.
    assert len(semi) == 2 and "SortMergeJoin" in semi[0] and "BroadcastHashJoin" in semi[1]
    # Of the untouched orders those that share one of 4,096 bits pass.
    passed = before["order_items"].join(touched, "order_id", "left_anti")
    assert bits_filter.sharing(passed, F.col("order_id"), bits).count() < 0.3 * 3000


def test_a_full_filter_loses_no_order(lake, table, rows, dims, monkeypatch):
    monkeypatch.setattr(bits_filter, "WORDS", 1)
    kept = upkeep.Upkeep(lake)
    kept.build(*facts(frames(table, FIRST)))
    changes = {"orders": [order(k, "c1", day(1)) for k in "123"], "order_reviews": [review("r1", "2", 1)]}
    kept.apply(frames(table, FIRST), {k: table(DDL[k], *r) for k, r in changes.items()}, "0")
    assert_same(kept.marts(dims), rebuilt(frames(table, upserted(FIRST, changes)), dims), rows)


def test_changes_of_the_sample_come_from_tables_cleaned_once(spark):
    before, _ = queries._order_changes(queries.Sample(spark, SAMPLE))
    for name, rows in before.items():
        assert all(f"/clean-{name}-" in path for path in rows.inputFiles())


def test_states_do_not_shuffle_the_lines_of_an_order_again(lake, table):
    sales, steps = facts(frames(table, FIRST))
    upkeep.marked(sales.withColumn("sign", F.lit(1))).write.parquet(f"{lake.root}/marked")
    lines = lake.spark.read.parquet(f"{lake.root}/marked")
    for name in ("daily", "customers", "products"):
        parts = upkeep.contributions(lines, steps.withColumn("sign", F.lit(1)))[name]
        assert parts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_no_rows(lake, table, dims):
    none = frames(table, {name: [] for name in DDL})
    kept = upkeep.Upkeep(lake)
    kept.build(*facts(none))
    assert kept.marts(dims)["sales_summary_mart"].collect() == []
    assert kept.marts(dims)["kpi_summary"].first()["total_orders"] == 0


# ---- the stream ----


def drop(lake, spark, name, *rows):
    frame = spark.createDataFrame(list(rows), DDL[name]).coalesce(1)
    frame.write.mode("append").csv(f"{lake.root}/drops/{name}", header=True, escape='"')


def streamed(lake):
    for name in ("orders", "order_items", "order_payments"):
        path = f"{lake.root}/drops/{name}"
        lake.spark.createDataFrame([], DDL[name]).write.mode("append").csv(path, header=True)
    start_daily_mart(lake, f"{lake.root}/drops", f"{lake.root}/checkpoint").awaitTermination()


def test_stream_takes_late_repeated_and_corrected_parts(lake, spark, table, rows, dims):
    drop(lake, spark, "order_items", *FIRST["order_items"][:3])  # lines before their orders
    streamed(lake)
    assert daily_mart(lake).collect() == []
    drop(lake, spark, "orders", *FIRST["orders"])
    drop(lake, spark, "order_payments", *FIRST["order_payments"])
    drop(lake, spark, "order_items", *FIRST["order_items"])  # three of them again
    streamed(lake)
    wanted = rebuilt(frames(table, FIRST), dims)["sales_summary_mart"]
    assert rows(daily_mart(lake)) == rows(wanted)
    changes = {
        "orders": [order("1", "c1", day(3))],  # moves into an earlier batch's day
        "order_items": [line("2", 1, "p2", 8.0)],
        "order_payments": [paid("1", 1, None), ("77", 1, "boleto", 1, 5.0)],
    }
    for name, some in changes.items():
        drop(lake, spark, name, *some)
    streamed(lake)
    streamed(lake)  # nothing new
    wanted = rebuilt(frames(table, upserted(FIRST, changes)), dims)["sales_summary_mart"]
    assert rows(daily_mart(lake)) == rows(wanted)


def test_the_session_keeps_its_state_store(lake, spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    streamed(lake)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_changes_of_the_sample_move_needed_columns_only(spark):
    before, changes = queries._order_changes(queries.Sample(spark, SAMPLE))
    for name in upkeep.OF_ORDERS:
        assert before[name].columns == changes[name].columns == upkeep.NEEDED[name]


class Held:
    """State in memory that counts how often it is asked."""

    def __init__(self):
        self.one, self.many, self.calls = None, {}, 0

    def get(self):
        self.calls += 1
        return self.one

    def update(self, value):
        self.calls, self.one = self.calls + 1, value

    def exists(self):
        self.calls += 1
        return self.one is not None

    def getValue(self, key):
        self.calls += 1
        return self.many.get(key)

    def containsKey(self, key):
        self.calls += 1
        return key in self.many

    def updateValue(self, key, value):
        self.calls, self.many[key] = self.calls + 1, value


def test_a_batch_asks_the_state_of_an_order_a_few_times():
    parts = OrderParts()
    parts.head, parts.parts = Held(), Held()

    def row(kind, part, value=None, file_time=1):
        return {
            "kind": kind, "part": part, "day": 20180101, "value": value, "price": value,
            "freight": value, "file_time": file_time, "file_path": "f",
        }

    rows = [row("order", 0), *[row("line", n, 10 * n) for n in range(40)]]
    (given,) = parts.handleInputRows(("1",), iter(rows), None)
    assert given["lines"] == 40 and given["value"] == 7800
    assert parts.head.calls + parts.parts.calls <= 6
    assert list(parts.handleInputRows(("1",), iter(rows), None)) == []  # the same again
    taken, added = parts.handleInputRows(("1",), iter([row("line", 39, 391)]), None)
    assert taken["value"] == -7800 and added["value"] == 7801 and added["lines"] == 40


NAMES = ["order_id", "h", "kind", "part", *lots.AMOUNTS, "file_time", "file_path"]
ARRIVING = pa.schema([*lots.ROWS][:-1]).append(pa.field("file_time", pa.int64())).append(pa.field("file_path", pa.string()))


def of_one_lot():
    """An empty processor of lots, and what asks its state."""
    held, several = [Held() for _ in range(3)], OrderLots()
    several.sizes = held[0]
    several.heads = lots.Pages(held[1], HEADS)
    several.parts = lots.Pages(held[2], lots.RECORDS, lots.PARTS)
    return several, held


def arriving(rng, orders, n):
    """Parts in random order and files, some twice, some NULL, one order with many parts."""

    def value(low, high):
        return None if rng.random() < 0.1 else rng.randint(low, high)

    rows = []
    for _ in range(n):
        key, kind = rng.choice([*orders, "hot"]), rng.choice([0, 1, 1, 2])
        number = rng.randint(-70, 200) if key == "hot" else rng.choice([-3, 1, 2, 2**31 - 1])
        amounts = [value(20180101, 20180105), None, None] if kind == 0 else [value(-50, 99) for _ in range(3)]
        if kind == 2:
            amounts[1:] = None, None
        h = (zlib.crc32(key.encode()) - 2**31 << 20) + 5
        file = rng.choice([(1, "a"), (1, "b"), (2, "A")])
        rows.append([key, h, kind, number if kind else 0, *amounts, *file])
    return rows


def by_lots(processor, rows, tasks):
    """Figures that a batch changes, by day, of rows that some tasks packed."""
    values = []
    for t in range(tasks):
        some = rows[t * len(rows) // tasks : (t + 1) * len(rows) // tasks]
        halves = [some[: len(some) // 2], some[len(some) // 2 :]]
        batches = [pa.RecordBatch.from_pylist([dict(zip(NAMES, r)) for r in h], ARRIVING) for h in halves]
        values += [row for batch in lots.packed(batches) for row in batch.to_pylist()]
    assert {v["lot"] for v in values} == {5}
    given = [{"days": r["days"]} for r in processor.handleInputRows((5,), iter(values), None)]
    batch = pa.RecordBatch.from_pylist(given, pa.schema([pa.field("days", pa.binary())]))
    return {tuple(r.values()) for b in days_of([batch]) for r in b.to_pylist()}


def by_orders(processors, rows):
    total = Counter()
    for key in dict.fromkeys(r[0] for r in rows):
        if key not in processors:
            processors[key] = OrderParts()
            processors[key].head, processors[key].parts = Held(), Held()
        some = [dict(zip(NAMES, r)) for r in rows if r[0] == key]
        for r in some:
            r["kind"], r["day"] = lots.KINDS[r["kind"]], r["value"]
        for change in processors[key].handleInputRows((key,), iter(some), None):
            for measure, figure in zip(upkeep.SALES, change[1:]):
                total[change[0], measure] += figure
    days = {day: tuple(total[day, m] for m in upkeep.SALES) for day, _ in total}
    return {(day, *figures) for day, figures in days.items() if any(figures)}


@pytest.mark.parametrize("page, piece, packed", [(4096, 1 << 18, 1 << 19), (4, 16, 40)])
def test_lots_of_orders_give_what_single_orders_give(monkeypatch, page, piece, packed):
    for name, size in (("PAGE", page), ("PIECE", piece), ("PACKED", packed)):
        monkeypatch.setattr(lots, name, size)
    rng = random.Random(page)
    processor, held = of_one_lot()
    single = {}
    for n in (30, 400, 5, 120):
        rows = arriving(rng, [str(i) for i in range(40)] + ["Ä", ""], n)
        assert by_lots(processor, rows, 3) == by_orders(single, rows)
    heads, head_pages, parts, part_pages = processor.sizes.one
    assert heads == len(single) and heads <= page * head_pages and parts <= page * part_pages
    assert set(held[1].many) == {(i,) for i in range(head_pages)}
    assert set(held[2].many) == {(i,) for i in range(part_pages)}


def test_a_batch_asks_the_state_of_many_orders_a_few_times():
    processor, held = of_one_lot()
    rows = [
        row
        for i in range(500)
        for row in ([str(i), 5, 0, 0, 20180101, None, None, 1, "f"], [str(i), 5, 1, 1, 150, 100, 50, 1, "f"])
    ]
    ((_, lines, orders, *_),) = by_lots(processor, rows, 2)
    assert lines == orders == 500
    assert sum(h.calls for h in held) <= 6
    assert by_lots(processor, rows, 2) == set()  # the same again
    assert sum(h.calls for h in held) <= 12


def test_an_order_without_header_or_lines_gives_nothing():
    names = ("known", "day", "lines", "value", "value_n", "price", "price_n", "freight", "freight_n", "paid", "paid_n")
    head = dict.fromkeys(names, 0) | {"known": True, "day": 20180101}
    assert OrderParts.gives(head) is None
    OrderParts.count(head, "line", (150, 100, None), 1)
    OrderParts.count(head, "payment", (120, None, None), 1)
    figures = dict(zip(upkeep.SALES, OrderParts.gives(head)[1]))
    assert figures["payment"] == 120 and figures["freight_n"] == 0 and figures["value"] == 150
    OrderParts.count(head, "line", (150, 100, None), -1)
    assert OrderParts.gives(head) is None
