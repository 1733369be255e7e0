import decimal

import duckdb
import pytest

from lading.sources.tables import equal_depth_bounds, range_predicates


def sizes(keys, predicates):
    """Rows per predicate, as a database counts them."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT)")
    if keys:
        con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    return [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]


def test_bounds_follow_the_rows(spark):
    # Nine tenths of the rows lie in a hundredth of the range.
    keys = [i % 100 for i in range(1800)] + list(range(0, 10_000, 50)) + [None] * 5
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    bounds = equal_depth_bounds(frame, "k", 8)
    assert bounds == sorted(set(bounds)) and len(bounds) == 7
    found = sizes(keys, range_predicates("k", bounds))
    assert sum(found) == len(keys) and max(found) < 1.3 * len(keys) / 8
    # From every tenth row alone the parts are about as even.
    sampled = equal_depth_bounds(spark.createDataFrame([(k,) for k in keys[::10]], "k long"), "k", 8)
    found = sizes(keys, range_predicates("k", sampled))
    assert sum(found) == len(keys) and max(found) < 1.6 * len(keys) / 8


@pytest.mark.parametrize("keys,parts", [([], 4), ([None], 4), ([3] * 50, 4), ([3] * 50 + [4], 4), ([1, 2, 3], 1), ([5], 9)])
def test_every_row_is_in_one_part(spark, keys, parts):
    bounds = equal_depth_bounds(spark.createDataFrame([(k,) for k in keys], "k long"), "k", parts)
    predicates = range_predicates("k", bounds)
    assert len(predicates) == len(bounds) + 1 <= parts
    assert sum(sizes(keys, predicates)) == len(keys)


def test_literals():
    assert range_predicates("k", ["a'b"]) == ["k < 'a''b' OR k IS NULL", "k >= 'a''b'"]
    assert range_predicates("k", [decimal.Decimal("1.5"), 3]) == ["k < 1.5 OR k IS NULL", "k >= 1.5 AND k < 3", "k >= 3"]
