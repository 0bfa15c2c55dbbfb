import datetime as dt

from pyspark.sql import functions as F

from dimstar.operators import quality, scd
from tests.bag import rows

D = dt.date


def snapshots(spark, data):
    return spark.createDataFrame(data, "k int, seg string, ts date")


REVERT = [
    (1, "A", D(2023, 1, 1)), (1, "A", D(2023, 2, 1)), (1, "B", D(2023, 3, 1)),
    (1, "A", D(2023, 4, 1)), (2, "C", D(2023, 1, 1)),
]
VERSION = ["k", "seg", "effective_date", "expiration_date", "is_current"]


def test_revert_makes_three_versions(spark):
    dim = scd.scd2(snapshots(spark, REVERT), "k", ["seg"], "ts")
    assert rows(dim, *VERSION) == [
        (1, "A", D(2023, 1, 1), D(2023, 2, 28), False),
        (1, "A", D(2023, 4, 1), None, True),
        (1, "B", D(2023, 3, 1), D(2023, 3, 31), False),
        (2, "C", D(2023, 1, 1), None, True),
    ]
    assert quality.scd_problems(dim, "k").count() == 0


def test_null_is_a_value(spark):
    dim = scd.scd2(
        snapshots(spark, [(1, None, D(2023, 1, 1)), (1, None, D(2023, 2, 1)), (1, "A", D(2023, 3, 1))]),
        "k", ["seg"], "ts",
    )
    assert dim.count() == 2


def test_merge_in_order_equals_one_load(spark):
    whole = scd.scd2(snapshots(spark, REVERT), "k", ["seg"], "ts")
    first = scd.scd2(snapshots(spark, REVERT[:2] + REVERT[4:]), "k", ["seg"], "ts")
    merged = scd.scd2_merge(first, snapshots(spark, REVERT[2:4]), "k", ["seg"], "ts")
    assert rows(merged, *VERSION) == rows(whole, *VERSION)


def stored(spark):
    dim = scd.scd2(snapshots(spark, [(1, "A", D(2023, 1, 1)), (1, "B", D(2023, 10, 1))]), "k", ["seg"], "ts")
    return dim.withColumn("sk", F.col("version").cast("bigint") + 100)


def test_late_row_splits_a_version_and_gets_a_new_key(spark):
    late = snapshots(spark, [(1, "C", D(2023, 5, 1))])
    merged = scd.scd2_merge(stored(spark), late, "k", ["seg"], "ts", surrogate="sk", next_key=500)
    assert rows(merged, "sk", *VERSION[1:]) == [
        (101, "A", D(2023, 1, 1), D(2023, 4, 30), False),
        (102, "B", D(2023, 10, 1), None, True),
        (500, "C", D(2023, 5, 1), D(2023, 9, 30), False),
    ]


def test_late_row_that_moves_a_start_keeps_the_key(spark):
    late = snapshots(spark, [(1, "B", D(2023, 5, 1))])
    merged = scd.scd2_merge(stored(spark), late, "k", ["seg"], "ts", surrogate="sk", next_key=500)
    assert rows(merged, "sk", *VERSION[1:]) == [
        (101, "A", D(2023, 1, 1), D(2023, 4, 30), False),
        (102, "B", D(2023, 5, 1), None, True),
    ]


def test_repeated_value_changes_nothing(spark):
    late = snapshots(spark, [(1, "A", D(2023, 5, 1)), (1, "B", D(2023, 12, 1))])
    merged = scd.scd2_merge(stored(spark), late, "k", ["seg"], "ts", surrogate="sk", next_key=500)
    assert rows(merged, "sk", *VERSION) == rows(stored(spark), "sk", *VERSION)


def test_restated_day_and_new_key(spark):
    late = snapshots(spark, [(1, "X", D(2023, 10, 1)), (9, "N", D(2023, 10, 1))])
    merged = scd.scd2_merge(stored(spark), late, "k", ["seg"], "ts", surrogate="sk", next_key=500)
    assert rows(merged, "k", "sk", "seg", "is_current") == [
        (1, 101, "A", False), (1, 102, "X", True), (9, 500, "N", True),
    ]


def test_overlay_overwrite_retain(spark):
    dim = stored(spark)
    assert {r["current_seg"] for r in scd.scd6_overlay(dim, "k", ["seg"]).collect()} == {"B"}
    base = spark.createDataFrame([(1, "old"), (2, None)], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "new"), (3, "other")], "k int, v string")
    assert rows(scd.scd1_overwrite(base, incoming, "k", ["v"]), "k", "v") == [(1, "new"), (2, "new")]
    assert rows(scd.scd0_retain(base, incoming, "k", ["v"]), "k", "v") == [(1, "old"), (2, "new")]


def test_as_of_is_inclusive(spark):
    dim = stored(spark)
    assert rows(scd.as_of(dim, D(2023, 9, 30)), "seg") == [("A",)]
    assert rows(scd.as_of(dim, D(2023, 10, 1)), "seg") == [("B",)]
    assert rows(scd.as_of(dim, D(2022, 12, 31)), "seg") == []


def test_stamp_keys(spark):
    events = spark.createDataFrame(
        [(1, D(2022, 6, 1)), (1, D(2023, 9, 30)), (1, D(2023, 10, 1)), (7, D(2023, 1, 1))], "k int, day date"
    )
    stamped = scd.stamp_keys(events, stored(spark), "k", "day", ["sk"])
    assert rows(stamped, "k", "day", "sk") == [
        (1, D(2022, 6, 1), 101), (1, D(2023, 10, 1), 102), (1, D(2023, 9, 30), 101), (7, D(2023, 1, 1), None),
    ]
    strict = scd.stamp_keys(events, stored(spark), "k", "day", ["sk"], open_start=False)
    assert rows(strict.filter("day = date'2022-06-01'"), "sk") == [(None,)]


def test_scd_health_finds_each_problem(spark):
    bad = spark.createDataFrame(
        [
            (1, D(2023, 1, 1), D(2023, 2, 15), False), (1, D(2023, 2, 1), None, True),
            (2, D(2023, 1, 1), D(2023, 1, 20), False), (2, D(2023, 2, 1), None, True),
            (3, D(2023, 1, 1), None, True), (3, D(2023, 2, 1), None, True),
            (4, D(2023, 1, 1), D(2023, 3, 1), True),
        ],
        "k int, effective_date date, expiration_date date, is_current boolean",
    )
    found = {(r["k"], r["problem"]) for r in quality.scd_problems(bad, "k").collect()}
    assert found == {(1, "overlap"), (2, "gap"), (3, "current rows"), (4, "closed")}
