"""The customer job: find duplicates, drop them and re-point what refers to them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lading.operators import address, dedup, spread
from lading.operators.spread import HOT_ROWS


@dataclass(frozen=True)
class MergeResult:
    crosswalk: str
    customers: str
    pickups: str
    n_removed: int
    references: dict[str, str] = field(default_factory=dict)


def merge_to(
    spark: SparkSession,
    customers: DataFrame,
    pickups: DataFrame,
    out: str,
    keys: list[str] = dedup.MATCH_KEYS,
    rules: address.Rules = address.DEFAULT,
    hot_rows: int = HOT_ROWS,
    references: dedup.References | None = None,
    salted: bool = False,
) -> MergeResult:
    """Write ``<out>/matches``, ``<out>/crosswalk``, ``<out>/customers``, ``<out>/pickups`` and one table per reference.

    The cleaned customers are written first and read back: addresses, the costly step, are
    cleaned once, and groups and joins work on narrow columns. The crosswalk is stored too, so that
    the later joins know its size. ``references`` names further tables and their columns that hold customer
    ids; all are checked before any is written, and the job raises if a row would lose its customer. With
    ``salted`` groups of at least ``hot_rows`` customers, and customers with as many mentions, counted once over all
    tables, have their rows spread; otherwise skew is left to the adaptive skew join.
    """
    spread.checked_hot_rows(hot_rows)
    taken = {"matches", "crosswalk", "customers", "lost", "hot"}
    tables = {"pickups": (pickups, ["customer_id"]), **(references or {})}
    if clash := taken & tables.keys():
        raise ValueError(f"references cannot be called {sorted(clash)}")
    paths = {name: f"{out}/{name}" for name in ("crosswalk", "customers")}
    dedup.match_frame(customers, rules).write.parquet(f"{out}/matches")
    resolved = dedup.with_survivor(spark.read.parquet(f"{out}/matches"), keys, hot_rows if salted else None)
    dedup.crosswalk(resolved).write.parquet(paths["crosswalk"])
    walk = spark.read.parquet(paths["crosswalk"])

    dedup.remove_duplicates(customers, walk).write.parquet(paths["customers"])
    remaining = spark.read.parquet(paths["customers"])
    dedup.lost_customers(customers, walk, remaining).write.parquet(f"{out}/lost")
    lost = dedup.lost_references(tables, spark.read.parquet(f"{out}/lost")).filter("n_lost > 0").collect()
    if lost:
        named = ", ".join(f"{row.n_lost} in {row.table_name}.{row.column_name}" for row in lost)
        raise RuntimeError(f"references would lose their customer: {named}; see {out}")
    hot = None
    if salted:
        dedup.shared_hot_keys(tables, hot_rows).write.parquet(f"{out}/hot")
        hot = spark.read.parquet(f"{out}/hot")
    written = {name: f"{out}/{name}" for name in tables}
    for name, moved in dedup.repoint_all(tables, walk, hot).items():
        moved.write.parquet(written[name])
    n_removed = walk.filter("old_id <> survivor_id").count()
    return MergeResult(**paths, pickups=written.pop("pickups"), n_removed=n_removed, references=written)
