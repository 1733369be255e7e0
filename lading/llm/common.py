"""Steps that several of the training-data operators share."""

from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lading.session import removed, run_folder

# Fixed value: what the operators take as a word.
WORD = r"[^\x20\x09-\x0D]+"

# Where stored tables are, for as long as their frames are in use.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

# Edges that one call of the local union-find holds at a time.
EDGE_CHUNK = 500_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    The written table survives lost executors and cuts the lineage; it is
    columnar and compressed, unlike a checkpoint.
    """
    spark = df.sparkSession
    folder = run_folder(spark, label)
    df.write.option("compression", "zstd").parquet(f"{folder}/table")
    table = spark.read.schema(df.schema).parquet(f"{folder}/table")
    _FOLDERS[table] = folder
    return table


def discarded(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more."""
    for table in tables:
        removed(table.sparkSession, _FOLDERS.pop(table))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` rows: enough for the work, at least the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def batches_by(batches, key: str):
    """Regroup sorted Arrow batches so that the rows of one key value come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(start, stop - start)
            if held and held[-1].column(held[-1].schema.get_field_index(key))[0] != part.column(
                part.schema.get_field_index(key)
            )[0]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def local_forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node reachable) of the graph given by the edges."""
    nodes, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = flat[: len(src)], flat[len(src) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # Lower the label of both ends and of the labels they carried before.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contract(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        node, root = local_forest(
            np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        )
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["src", "dst"])

    for batch in batches:
        src, dst = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        held.append((src, dst))
        size += len(src)
        if size >= EDGE_CHUNK:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, component): each node of ``edges`` with the smallest node reachable.

    ``edges`` has long columns src and dst. Every partition first reduces its
    edges to a forest, so that a node with very many links keeps one per
    partition; then large-star and small-star steps alternate until the edges
    stay the same. Minima are aggregated before the shuffle, and the joins that
    carry a hub's rows are plain joins, which adaptive execution can split.
    Nodes without an edge do not appear.
    """
    spark = edges.sparkSession
    proper = edges.filter("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    now = stored(proper.mapInArrow(_contract, "src long, dst long").distinct(), label)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy(F.col("src").alias("at")).agg(
            F.least(F.min("dst"), F.first("src")).alias("low")
        )
        large = (
            both.filter("dst > src")
            .join(low, F.col("src") == F.col("at"))
            .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        )
        large = stored(large.distinct(), label)
        least = large.groupBy(F.col("src").alias("at")).agg(F.min("dst").alias("low"))
        small = (
            large.join(least, F.col("src") == F.col("at"))
            .filter("dst <> low")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .unionByName(least.select(F.col("at").alias("src"), F.col("low").alias("dst")))
        )
        past, now = now, stored(small.distinct(), label)
        discarded(past, large)
        before, state = state, _state(now)
        if state == before:
            break
    # All edges now lead from a node to the smallest of its component.
    members = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return members.unionByName(roots)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*"), F.coalesce(F.sum(F.xxhash64("src", "dst") % 1_000_000_007), F.lit(0))
    ).first()
    return int(row[0]), int(row[1])


def numbered(df: DataFrame, order_by: list[str], label: str, name: str = "place") -> DataFrame:
    """Store ``df`` in the order of ``order_by`` with each row's place, from 0.

    Range partitions are sorted and numbered by themselves; the sizes of the
    partitions before each are added from a table of one row per partition.
    """
    slot = F.col("_slot")
    placed = stored(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        label,
    ).withColumns({"_part": F.shiftright(slot, 33), "_at": slot.bitwiseAND(F.lit((1 << 33) - 1))})
    # One row per partition, however many rows there are: this window is small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_slot", "_part", "_at", "_before")
    )


def in_order(rows: DataFrame, order_by: list[str], n_rows: int, per_task: int = 50_000) -> DataFrame:
    """``rows`` in range partitions, each sorted, for tasks that compare neighbours.

    Neighbours on either side of a partition's border do not meet; several
    orderings make up for that.
    """
    ordered = rows.repartitionByRange(tasks(rows.sparkSession, n_rows, per_task), *order_by)
    return ordered.sortWithinPartitions(*order_by)


def carried(batches, width: int, piece: int = 4096):
    """(table, count) pieces of a sorted partition: ``count`` new rows and the ``width`` after them."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
        at = 0
        while held.num_rows - at >= piece + width:
            yield held.slice(at, piece + width), piece
            at += piece
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held, held.num_rows


class Links:
    """The links that a task finds, reduced to a forest whenever they become many."""

    def __init__(self) -> None:
        self.src: list[np.ndarray] = []
        self.dst: list[np.ndarray] = []
        self.size = 0

    def add(self, src: np.ndarray, dst: np.ndarray) -> None:
        self.src.append(src)
        self.dst.append(dst)
        self.size += len(src)
        if self.size > 2 * EDGE_CHUNK:
            self._reduce()

    def _reduce(self) -> None:
        node, root = local_forest(np.concatenate(self.src), np.concatenate(self.dst))
        # What is left of a forest is kept; it has fewer edges than the task has seen nodes.
        self.src, self.dst, self.size = [node], [root], 0

    def batches(self):
        if any(map(len, self.src)):
            self._reduce()
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.src[0]), pa.array(self.dst[0])], names=["src", "dst"]
            )
