import pytest
from pyspark.errors import PySparkException

from bazaarlake.operators.upsert import upsert, upsert_partitions

DDL = "k1 string, k2 int, v string"


def test_replaces_inserts_and_keeps(table, rows):
    target = table(DDL, ("a", 1, "old"), ("a", 2, "kept"), (None, 1, "null key"))
    source = table(DDL, ("a", 1, "new"), ("b", 1, "added"), (None, 1, "null again"))
    assert rows(upsert(target, source, ["k1", "k2"])) == sorted(
        [
            ("a", 1, "new"),
            ("a", 2, "kept"),
            ("b", 1, "added"),
            (None, 1, "null key"),
            (None, 1, "null again"),
        ],
        key=str,
    )


def test_is_idempotent_for_complete_keys(table, rows):
    target = table(DDL, ("a", 1, "old"))
    source = table(DDL, ("a", 1, "new"), ("b", 1, "added"))
    once = upsert(target, source, ["k1", "k2"])
    assert rows(upsert(once, source, ["k1", "k2"])) == rows(once)


def test_two_source_rows_for_one_target_row_fail(table):
    target = table(DDL, ("a", 1, "old"))
    source = table(DDL, ("a", 1, "x"), ("a", 1, "y"))
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, source, ["k1", "k2"]).collect()


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_two_source_rows_without_target_are_both_inserted(
    table, rows, settings, broadcast
):
    settings(autoBroadcastJoinThreshold=broadcast)
    target = table(DDL, ("z", 1, "old"))
    source = table(DDL, ("a", 1, "x"), ("a", 1, "y"))
    assert len(rows(upsert(target, source, ["k1", "k2"]))) == 3


def test_source_takes_target_types(table):
    target = table("zip string, v double", ("01310", 1.0))
    source = table("v int, zip string, extra int", (2, "04538", 9))
    got = upsert(target, source, ["zip"])
    assert got.dtypes == target.dtypes
    assert set(got.collect()) == {("01310", 1.0), ("04538", 2.0)}


def test_missing_source_column_is_refused(table):
    with pytest.raises(ValueError, match="k2"):
        upsert(table(DDL), table("k1 string, v string"), ["k1"])


PARTS = "k int, v string, year int, month int"


def test_only_touched_partitions_result(table, rows):
    target = table(
        PARTS, (1, "old", 2017, 1), (2, "same", 2017, 1), (3, "other", 2017, 2)
    )
    source = table(PARTS, (1, "new", 2017, 1), (4, "added", 2017, 3))
    got = upsert_partitions(target, source, ["k"], ["year", "month"])
    assert rows(got) == [
        (1, "new", 2017, 1),
        (2, "same", 2017, 1),
        (4, "added", 2017, 3),
    ]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_row_that_would_change_partition_fails(table, settings, broadcast):
    settings(autoBroadcastJoinThreshold=broadcast)
    target = table(PARTS, (1, "old", 2017, 1))
    source = table(PARTS, (1, "new", 2017, 2))
    with pytest.raises(PySparkException, match="another partition"):
        upsert_partitions(target, source, ["k"], ["year", "month"]).collect()
