import pytest

from lading.operators import dedup

ROWS = [
    (1, "Ann", "5 MAIN RD", "X"),
    (2, " ann ", "5 MAIN RD, X", "X"),
    (3, "ANN", "5 MAIN RD", "Y"),
    (4, "Bob", "", "X"),
    (5, "Bob", None, "X"),
    (6, None, "5 MAIN RD", "X"),
    (7, None, "5 MAIN RD", "X"),
    (8, "Cy", "MAIN RD", "X"),
    (9, "Cy", "MAIN RD.", "X"),
    (10, "Cy", "MAIN RD", "X"),
]
WALK = {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 8}


def customers(spark):
    return spark.createDataFrame(
        ROWS, "customer_id long, customer_name string, address string, town string"
    )


def resolved(spark, **options):
    return dedup.with_survivor(dedup.match_frame(customers(spark)), **options)


def test_crosswalk(spark):
    assert dict(dedup.crosswalk(resolved(spark)).collect()) == WALK


def test_crosswalk_with_salted_groups(spark, any_hot_rows):
    assert dict(dedup.crosswalk(resolved(spark, hot_rows=2)).collect()) == WALK


def test_key_list_is_a_parameter(spark):
    walk = dict(dedup.crosswalk(resolved(spark, keys=["match_name", "building", "street"])).collect())
    assert walk[3] == 1


def test_survivors_and_removal(spark):
    kept = {new for new in WALK.values()}
    assert {r.customer_id for r in dedup.survivors(resolved(spark)).collect()} == kept
    left = dedup.remove_duplicates(customers(spark), dedup.crosswalk(resolved(spark)))
    assert left.columns == customers(spark).columns
    assert {r.customer_id for r in left.collect()} == kept


def test_repoint_and_integrity(spark, any_hot_rows):
    pickups = spark.createDataFrame(
        [(100 + i, c) for i, c in enumerate([2, 9, 9, 10, 3, -1, None])], "pickup_id long, customer_id long"
    )
    walk = dedup.crosswalk(resolved(spark))
    expected = {100: 1, 101: 8, 102: 8, 103: 8, 104: 3, 105: -1, 106: None}
    moved = dedup.repoint(pickups, walk)
    assert moved.columns == pickups.columns
    assert dict(moved.collect()) == expected
    assert dict(dedup.repoint(pickups, walk, hot_rows=2).collect()) == expected
    remaining = dedup.remove_duplicates(customers(spark), walk)
    assert dedup.lost_customers(customers(spark), walk, remaining).count() == 0
    # Without re-pointing, the pickups of merged customers would be lost.
    lost = dedup.lost_customers(customers(spark), walk.filter("false"), remaining)
    assert {r.customer_id for r in lost.collect()} == {2, 9, 10}
    assert {r.pickup_id for r in dedup.lost_pickups(pickups, lost).collect()} == {100, 101, 102, 103}


def test_several_tables_with_one_hot_key_plan(spark, any_hot_rows):
    walk = dedup.crosswalk(resolved(spark))
    calls = spark.createDataFrame(
        [(1, 2, 9, "x"), (2, None, 10, "y"), (3, 77, 1, "z"), (3, 77, 1, "z")],
        "call_id long, caller long, survivor_id long, note string",
    )
    pickups = spark.createDataFrame([(5, 9), (6, 2), (7, 4)], "pickup_id long, customer_id long")
    tables = {"pickups": (pickups, ["customer_id"]), "calls": (calls, ["caller", "survivor_id"])}
    hot = dedup.shared_hot_keys(tables, 3)
    # 77 and 1 twice, 2 twice, 9 twice: none has three mentions but with a null, which no customer is.
    assert hot.count() == 0
    hot = dedup.shared_hot_keys(tables, 2)
    assert {r.customer_id for r in hot.collect()} == {1, 2, 9, 77}
    for salted in (None, hot):
        moved = dedup.repoint_all(tables, walk, salted)
        assert dict(moved["pickups"].collect()) == {5: 8, 6: 1, 7: 4}
        assert moved["calls"].columns == calls.columns
        assert sorted(map(tuple, moved["calls"].collect()), key=repr) == [
            (1, 1, 8, "x"), (2, None, 8, "y"), (3, 77, 1, "z"), (3, 77, 1, "z"),
        ]
    lost = spark.createDataFrame([(9,), (10,), (2,)], "customer_id long")
    assert sorted(map(tuple, dedup.lost_references(tables, lost).collect())) == [
        ("calls", "caller", 1), ("calls", "survivor_id", 2), ("pickups", "customer_id", 2),
    ]


def test_few_rows_are_not_hot(spark):
    pickups = spark.createDataFrame([(1, 2)], "pickup_id long, customer_id long")
    walk = dedup.crosswalk(resolved(spark))
    with pytest.raises(ValueError, match="hot rows"):
        dedup.repoint(pickups, walk, hot_rows=10)
    with pytest.raises(ValueError, match="hot rows"):
        resolved(spark, hot_rows=10)


def test_settings_that_make_many_keys_hot_are_refused(spark):
    pickups = spark.createDataFrame([(1, 1)], "pickup_id long, customer_id long")
    with pytest.raises(ValueError, match="hot rows"):
        dedup.shared_hot_keys({"pickups": (pickups, ["customer_id"])}, 10)
