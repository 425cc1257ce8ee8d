import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlake import contracts as c
from bazaarlake.functions import dates, money, ranking, text, tiers
from bazaarlake.functions.growth import period_growth


def test_ratio_rounds_half_away_from_zero(table):
    rng = random.Random(7)
    pairs = [(rng.randint(-10**9, 10**9), rng.randint(1, 10**4)) for _ in range(500)]
    pairs += [(201, 2), (-201, 2), (1, 8), (-1, 8), (1005, 1000), (0, 3), (5, 0)]
    df = table("num bigint, den bigint", *pairs)
    for num, den, got in df.select(
        "num", "den", money.ratio(F.col("num"), F.col("den"))
    ).collect():
        if den == 0:
            assert got is None
            continue
        exact = (Decimal(num) / Decimal(den)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got == float(exact), (num, den)


def test_ratio_of_wide_totals(table):
    df = table("num decimal(28,0), den bigint", (Decimal(10) ** 20 + 1, 2))
    assert df.select(money.ratio(F.col("num"), F.col("den"), 0)).first()[0] is not None


def test_round2_equals_round(table):
    rng = random.Random(3)
    values = [rng.uniform(-1e6, 1e6) for _ in range(300)]
    values += [rng.randint(-10**8, 10**8) / 1000 for _ in range(500)]
    values += [1.005, 2.675, -1.005, 0.1 + 0.2, 0.0, 1e-9]
    df = table("x double", *[(v,) for v in values])
    differing = df.filter(money.round2(F.col("x")) != F.round("x", 2))
    assert differing.collect() == []


def test_money_sums_do_not_depend_on_order(table):
    df = table("x double", *[(0.1,)] * 1000, (1e9,), (-1e9,))
    x = F.col("x")
    assert df.agg(money.sum_money(x)).first()[0] == 100.0
    assert df.filter("x < 1 and x > 0").agg(money.mean_money(x)).first()[0] == 0.1


def test_pad_zip(table):
    df = table("z int", (1310,), (4538,), (123456,), (None,))
    got = [r[0] for r in df.select(text.pad_zip(F.col("z"))).collect()]
    assert got == ["01310", "04538", "12345", None]


def test_text(table):
    df = table("t string", ("  Sao PAULO ",), ("cama_mesa_banho",))
    got = df.select(text.tidy(F.col("t")), text.spaced(F.col("t"))).collect()
    assert got[0][0] == "sao paulo"
    assert got[1][1] == "cama mesa banho"


def test_instants_and_keys(table):
    df = table("t string", ("2024-04-13 10:00:00",), ("2024-04-13",), ("bad",), (None,))
    when = dates.instant(F.col("t"))
    got = df.select(when, dates.date_key(when)).collect()
    assert [r[1] for r in got] == [20240413, 20240413, None, None]
    assert got[0][0] == datetime(2024, 4, 13, 10)


def test_days_between_counts_calendar_days(table):
    df = table(
        "a timestamp_ntz, b timestamp_ntz",
        (datetime(2020, 1, 1, 23, 50), datetime(2020, 1, 2, 0, 10)),
    )
    assert df.select(dates.days_between(F.col("b"), F.col("a"))).first()[0] == 1


def test_calendar(table):
    seen = table("t timestamp_ntz", (datetime(2016, 9, 4),), (datetime(2018, 10, 17),))
    days = dates.day_attributes(dates.calendar_days(dates.whole_years(seen, "t")))
    assert days.count() == 1096
    first = days.filter("date_key = 20160101").first()
    assert (first.day_name, first.day_of_week, first.is_weekend) == ("Friday", 6, False)
    assert days.filter("is_weekend").select("day_name").distinct().count() == 2
    assert days.filter("date_key = 20160229").first().full_date == date(2016, 2, 29)


@pytest.mark.parametrize(
    ("spent", "label"),
    [
        (1000.0, "High (1000+)"),
        (999.99, "Medium (500-999)"),
        (500.0, "Medium (500-999)"),
        (100.0, "Low (100-499)"),
        (99.99, "Minimal (<100)"),
        (None, "Minimal (<100)"),
    ],
)
def test_spending_tiers(table, spent, label):
    got = table("v double", (spent,)).select(
        tiers.tier(F.col("v"), c.SPENDING_TIERS, c.SPENDING_TIER_REST)
    )
    assert got.first()[0] == label


def test_growth_uses_previous_present_row(table):
    df = table(
        "d int, v double", (1, 100.0), (2, 150.0), (5, 0.0), (6, 10.0), (7, 9.99)
    )
    got = {r.d: r.growth_pct for r in period_growth(df, "v", "d").collect()}
    assert got == {1: None, 2: 50.0, 5: -100.0, 6: None, 7: -0.1}


def test_growth_from_negative_base(table):
    df = table("d int, v double", (1, -100.0), (2, -50.0))
    got = {r.d: r.growth_pct for r in period_growth(df, "v", "d").collect()}
    assert got[2] == -50.0  # (-50 - -100) / -100


def test_growth_within_groups(table):
    df = table("g string, d int, v double", ("a", 1, 1.0), ("b", 2, 5.0), ("a", 3, 2.0))
    got = period_growth(df, "v", "d", ["g"]).collect()
    assert {(r.g, r.d): r.growth_pct for r in got} == {
        ("a", 1): None,
        ("a", 3): 100.0,
        ("b", 2): None,
    }


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_value_ranks_against_brute_force(table, descending, width):
    rng = random.Random(width)
    values = [rng.randint(-50, 50) for _ in range(150)] + [13] * 75 + [None] * 5
    df = table("v int, w bigint", *[(v, i) for i, v in enumerate(values)])
    got = ranking.value_ranks(df, "v", descending=descending, total="w", width=width)
    present = [(v, i) for i, v in enumerate(values) if v is not None]

    def ahead(a, b):
        return a > b if descending else a < b

    expected = {
        v: (
            1 + sum(ahead(o, v) for o, _ in present),
            1 + len({o for o, _ in present if ahead(o, v)}),
            sum(o == v for o, _ in present),
            sum(w for o, w in present if o == v or ahead(o, v)),
        )
        for v, _ in present
    }
    assert {
        r.v: (r.rank_no, r.dense_rank_no, r.row_count, int(r.running_total))
        for r in got.collect()
    } == expected


def test_quantile_groups_keep_ties_together(table):
    values = [1] * 40 + list(range(2, 62))
    df = table("v int", *[(v,) for v in values], (None,))
    cuts = ranking.quantile_cuts(df, "v", 5, width=8)
    got = df.select(
        "v", ranking.quantile_group(F.col("v"), cuts, 5).alias("g")
    ).distinct()
    expected = {v: 1 + 5 * sum(o < v for o in values) // len(values) for v in values}
    assert {r.v: r.g for r in got.collect()} == {**expected, None: None}


def test_value_ranks_sends_no_unbounded_group_to_one_task(table):
    df = table("v int", (1,), (2,))
    plan = ranking.value_ranks(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    # The only window without partition keys runs over one row per range.
    assert plan.count("windowspecdefinition(_range") >= 1
    assert "windowspecdefinition(v#" not in plan
