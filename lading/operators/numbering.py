"""Consecutive row numbers and fixed-size batches without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.session import shared_folder

# Fixed value: rows per export batch.
BATCH_SIZE = 500

# monotonically_increasing_id holds the partition above this bit and the row's place in it below.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order_by: list[str], name: str = "row_number") -> DataFrame:
    """Add 1, 2, 3, ... in the order of ``order_by``, in parallel.

    Rows are range-partitioned and sorted, each gets its place within its
    partition, and the sizes of the partitions before it are added. The placed
    rows are checkpointed: sizes and places must come from one and the same
    partitioning, also after an executor is lost. Rows that agree in ``order_by``
    are told apart by a hash of their other columns, so that a value with very
    many rows fills more than one partition. Keep wide columns out of ``df``.
    """
    shared_folder(df.sparkSession)
    slot = F.col("_slot")
    others = [c for c in df.columns if c not in order_by]
    tie = [F.xxhash64(*others)] if others else []
    placed = (
        df.repartitionByRange(*order_by, *tie)
        .sortWithinPartitions(*order_by, *tie)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumns(
            {
                "_partition": F.shiftright(slot, _PLACE_BITS),
                "_place": slot.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
            }
        )
    )
    # One row per partition, however many rows there are: this window is small.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_partition")
        .count()
        .select("_partition", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_partition", "_place", "_offset", "_slot")
    )


def assign_batches(
    df: DataFrame, order_by: list[str], batch_size: int = BATCH_SIZE, name: str = "batch_id"
) -> DataFrame:
    """Add the number of the batch, from 0, that each row falls into."""
    numbered = number_rows(df, order_by, "_row_number")
    batch = F.floor((F.col("_row_number") - 1) / batch_size).cast("long")
    return numbered.withColumn(name, batch).drop("_row_number")


def number_range(numbered: DataFrame, first: int, last: int, name: str = "row_number") -> DataFrame:
    """Rows numbered ``first`` to ``last``, both included."""
    return numbered.filter(F.col(name).between(first, last))
