from datetime import datetime

from bazaarlake.operators import quality


def test_profile_and_nulls(table, rows):
    df = table("a int, b string", (1, None), (None, None), (3, "x"))
    assert rows(quality.profile_columns(df)) == [
        ("a", "int", 2, 1, 3),
        ("b", "string", 1, 2, 3),
    ]
    assert quality.null_counts(df).first().asDict() == {"a": 1, "b": 2}


def test_profile_is_one_pass(table):
    df = table("a int, b string", (1, "x"))
    plan = quality.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_profile_of_empty_table(table, rows):
    assert rows(quality.profile_columns(table("a int"))) == [("a", "int", 0, 0, 0)]


def test_negatives(table, rows):
    df = table("a int, b double", (-1, 0.0), (None, -0.5), (-3, 2.0))
    assert rows(quality.negative_counts(df, ["a", "b"])) == [("a", 2), ("b", 1)]


def test_duplicates(table, rows):
    df = table("a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert rows(quality.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_orphans(table, rows):
    child = table("k string, v int", ("a", 1), ("x", 2), (None, 3))
    parent = table("id string", ("a",))
    assert rows(quality.orphan_rows(child, parent, "k", "id")) == [
        ("x", 2),
        (None, 3),
    ]


def test_temporal_order_is_by_day(table):
    df = table(
        "a timestamp_ntz, b timestamp_ntz",
        (datetime(2018, 1, 2, 9), datetime(2018, 1, 2, 8)),
        (datetime(2018, 1, 3), datetime(2018, 1, 2)),
        (None, datetime(2018, 1, 2)),
    )
    assert quality.temporal_violations(df, "a", "b").count() == 1


def test_domains(table, rows):
    df = table("c string", ("x",), ("x",), ("y",), (None,))
    assert rows(quality.value_frequency(df, "c")) == [("x", 2), ("y", 1), (None, 1)]
    assert rows(quality.distinct_values(df, "c")) == [("x",), ("y",), (None,)]
    assert quality.matching(df, "c", "x%").count() == 2


def test_zip_ranges(table, rows):
    df = table("z string", ("01310",), ("99999",), ("9999A",), ("123",), (None,))
    assert dict(rows(quality.zip_ranges(df, "z"))) == {
        "leading zero": 1,
        "plain": 1,
        "out of range": 1,
        "wrong length": 1,
        "missing": 1,
    }


def test_payment_mismatches(table):
    df = table(
        "total_item_value double, total_payment_value double",
        (120.0, 299.9),
        (5.0, 5.0),
        (5.0, None),
    )
    assert quality.payment_mismatches(df).count() == 1


def test_counts_and_validation(table, rows):
    a, b = table("x int", (1,), (2,)), table("x int")
    counts = quality.row_counts({"a": a, "b": b, "c": a})
    assert rows(counts) == [("a", 2), ("b", 0), ("c", 2)]
    wanted = table(
        "table_name string, expected_count bigint", ("a", 2), ("b", 1), ("gone", 1)
    )
    assert rows(quality.validate_counts(counts, wanted)) == [
        ("a", 2, 2, "PASS"),
        ("b", 1, 0, "FAIL"),
        ("c", None, 2, "EXISTS"),
        ("gone", 1, None, "MISSING"),
    ]
    assert {r.status for r in quality.validate_counts(counts).collect()} == {"EXISTS"}
