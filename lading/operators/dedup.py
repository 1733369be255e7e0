"""Duplicate customers: finding them, removing them, re-pointing what refers to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.functions import tsql
from lading.operators import address
from lading.operators.spread import checked_hot_rows, hot_keys, spread_join

MATCH_KEYS = ["match_name", "building", "street", "city"]


def match_frame(customers: DataFrame, rules: address.Rules = address.DEFAULT) -> DataFrame:
    """Customers with their own address cleaned and the columns duplicates agree in."""
    cleaned = address.clean(customers, rules)
    return cleaned.select(
        "customer_id",
        "customer_name",
        F.upper(F.trim("customer_name")).alias("match_name"),
        "building",
        "street",
        "city",
    )


def duplicate_groups(matches: DataFrame, keys: list[str] = MATCH_KEYS) -> DataFrame:
    """``keys, survivor_id, n_rows`` of every group of two or more.

    A customer without a name, or with neither building nor street, matches nobody.
    """
    known = (tsql.trimmed_length("building") > 0) | (tsql.trimmed_length("street") > 0)
    named = tsql.trimmed_length("match_name") > 0
    return (
        matches.filter(named & known)
        .groupBy(*keys)
        .agg(F.min("customer_id").alias("survivor_id"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def with_survivor(
    matches: DataFrame, keys: list[str] = MATCH_KEYS, hot_rows: int | None = None
) -> DataFrame:
    """Every customer with the smallest id of its group as ``survivor_id``.

    A group is one row of the join's other side, so large groups are left to the adaptive skew join; with
    ``hot_rows``, groups of that size are salted instead: their sizes are known by then.
    """
    groups = duplicate_groups(matches, keys)
    if hot_rows is None:
        named = groups.select(*[F.col(k).alias(f"_group_{k}") for k in keys], "survivor_id")
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
        joined = matches.join(named, same, "left")
    else:
        checked_hot_rows(hot_rows)
        hot = groups.filter(F.col("n_rows") >= hot_rows)
        joined = spread_join(matches, groups, keys, hot, spread_by=["customer_id"])
    survivor = F.coalesce("survivor_id", "customer_id").alias("survivor_id")
    return joined.select(*matches.columns, survivor)


def crosswalk(resolved: DataFrame) -> DataFrame:
    """``old_id, survivor_id`` for every customer."""
    return resolved.select(F.col("customer_id").alias("old_id"), "survivor_id")


def survivors(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("customer_id") == F.col("survivor_id")).drop("survivor_id")


def remove_duplicates(customers: DataFrame, walk: DataFrame) -> DataFrame:
    """The customer table without the customers merged into another."""
    merged = walk.filter(F.col("old_id") != F.col("survivor_id"))
    return customers.join(merged, F.col("customer_id") == F.col("old_id"), "left_anti")


def repoint(
    table: DataFrame,
    walk: DataFrame,
    hot_rows: int | None = None,
    column: str = "customer_id",
    hot: DataFrame | None = None,
) -> DataFrame:
    """``table`` with ``column`` replaced by the survivor of the customer it names; unknown ids stay.

    Only merged customers are looked up. Skew of the column is left to the
    adaptive skew join; with ``hot_rows``, customers with that many rows are
    found by a count and salted instead. ``hot`` gives these customers, where they are known.
    """
    merged = walk.filter(F.col("old_id") != F.col("survivor_id")).select(
        F.col("old_id").alias(column), F.col("survivor_id").alias("_survivor_id")
    )
    if hot is None and hot_rows is not None:
        hot = hot_keys(table.select(F.col(column).alias("customer_id")), ["customer_id"], checked_hot_rows(hot_rows))
    if hot is None:
        joined = table.join(merged, column, "left")
    else:
        others = [c for c in table.columns if c != column]
        joined = spread_join(table, merged, [column], hot.select(F.col("customer_id").alias(column)), spread_by=others)
    new_id = F.coalesce("_survivor_id", column).alias(column)
    return joined.select(*[new_id if c == column else F.col(c) for c in table.columns])


# Tables that refer to customers: name, rows, and the columns that hold a customer's id.
References = dict[str, tuple[DataFrame, list[str]]]


def shared_hot_keys(references: References, hot_rows: int) -> DataFrame:
    """``customer_id`` of the customers with at least ``hot_rows`` mentions in all tables together.

    Counted in one aggregation, where every mention is reduced before the shuffle.
    """
    mentions = [
        table.select(F.col(column).alias("customer_id"))
        for table, columns in references.values()
        for column in columns
    ]
    return hot_keys(reduce(DataFrame.unionAll, mentions), ["customer_id"], checked_hot_rows(hot_rows))


def repoint_all(references: References, walk: DataFrame, hot: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table with all its references re-pointed; ``hot`` are the ``shared_hot_keys``, if salted."""
    moved = {}
    for name, (table, columns) in references.items():
        for column in columns:
            table = repoint(table, walk, column=column, hot=hot)
        moved[name] = table
    return moved


def lost_references(references: References, lost: DataFrame) -> DataFrame:
    """Rows (table_name, column_name, n_lost): how many references point to one of the ``lost`` customers.

    One row per column that refers to customers. ``lost`` should be stored, so that a short list is broadcast.
    """
    counts = [
        table.select(F.col(column).alias("customer_id"))
        .join(lost.select("customer_id"), "customer_id", "left_semi")
        .agg(F.count(F.lit(1)).alias("n_lost"))
        .select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "n_lost")
        for name, (table, columns) in references.items()
        for column in columns
    ]
    return reduce(DataFrame.unionAll, counts)


def lost_customers(customers: DataFrame, walk: DataFrame, remaining: DataFrame) -> DataFrame:
    """``customer_id`` of the customers whose survivor is not among the remaining; must be empty.

    One row per customer on either side, however many pickups there are.
    """
    moved = customers.select("customer_id").join(
        walk.withColumnRenamed("old_id", "customer_id"), "customer_id", "left"
    )
    survivor = F.coalesce("survivor_id", "customer_id").alias("_survivor_id")
    kept = remaining.select(F.col("customer_id").alias("_survivor_id"))
    return moved.select("customer_id", survivor).join(kept, "_survivor_id", "left_anti").select("customer_id")


def lost_pickups(pickups: DataFrame, lost: DataFrame) -> DataFrame:
    """The pickups of lost customers; ``lost`` should be stored, so that a short list is broadcast."""
    return pickups.join(lost.select("customer_id"), "customer_id", "left_semi")
