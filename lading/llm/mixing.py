"""Mixing sources to target weights by pivotal rounding.

Every document of a source gets the same fractional number of copies, target over
size of the source. The whole part is certain; the fractions are rounded together:
two documents are paired and words are moved from one to the other, in a random
direction with odds that keep both expectations, until one of them has a whole
number of copies. The words taken from the pair stay the same, so a group of
documents ends with its words intact and at most one fraction left. Leftover
fractions are rounded in the same way, level by level, until a source has one left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import batches_by, numbered, stored, word_count

# A document is never taken more often than this.
MOST_COPIES = 3

# Documents that one task pairs off at a time, and leftovers that meet one level up.
GROUP = 4096

# Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)


def targets(items: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Rows (source, source_size, n_items, target) for items with source and size.

    Sources in code point order, null last, weigh as in ``weights``, repeating. A target stops
    at ``most`` times its source's size; the excess is shared again by weight
    among the others until none is above. Only sums over all sources reach the driver.
    """
    sums = items.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n_items")
    )
    ordered = numbered(
        sums.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "sources"
    )
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("place") % len(weights)).cast("int")]
    now = stored(
        ordered.select("source", "source_size", "n_items", weight.alias("weight")), "weights"
    )
    ceiling = F.col("source_size") * float(most)
    share = None
    while True:
        full = F.lit(False) if share is None else F.col("weight") * share > ceiling
        total, fixed, free = now.agg(
            F.sum("source_size"),
            F.sum(F.when(full, ceiling)),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        # Words of a unit of weight; what the full sources cannot take goes to the others.
        new = (float(total or 0) - float(fixed or 0)) / free if free else share or 0.0
        if share is not None and new <= share:
            break
        share = new
    target = F.least(F.col("weight") * F.lit(float(share)), ceiling)
    return now.select("source", "source_size", "n_items", target.cast("double").alias("target"))


def _draw(seed: int, keys: np.ndarray) -> np.random.Generator:
    digest = hashlib.blake2b(keys.tobytes(), digest_size=16, key=seed.to_bytes(8, "little"))
    return np.random.Generator(np.random.PCG64(int.from_bytes(digest.digest(), "little")))


def pivotal(sizes: np.ndarray, part: np.ndarray, chance: np.ndarray) -> int:
    """Round ``part`` in place; the words sum(sizes * part) stay the same.

    ``chance`` holds a number in [0, 1) for every step. Returns the place of the one
    fraction that is left, or -1.
    """
    held = -1
    for i in range(len(part)):
        if part[i] <= 0.0 or part[i] >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        # Words that can move from b to a, and from a to b.
        up = min((1.0 - part[a]) * sizes[a], part[b] * sizes[b])
        down = min(part[a] * sizes[a], (1.0 - part[b]) * sizes[b])
        step = up if chance[i] * (up + down) < down else -down
        x, y = part[a] + step / sizes[a], part[b] - step / sizes[b]
        # Whoever reached a whole number is set to it exactly; rounding errors stay below 1e-9.
        x = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
        y = 0.0 if y < 1e-9 else 1.0 if y > 1 - 1e-9 else y
        part[a], part[b] = x, y
        held = a if 0.0 < x < 1.0 else b if 0.0 < y < 1.0 else -1
    return held


def _taken(column: pa.ChunkedArray, order: np.ndarray) -> pa.Array:
    picked = column.take(pa.array(order))
    return picked.combine_chunks() if isinstance(picked, pa.ChunkedArray) else picked


def _round_groups(seed: int, level: int, last: bool):
    """Rounds every group; on the last level the leftover goes to the nearer whole number.

    No partner is left then to take words from, and the source comes closest to its target.
    """

    def run(batches):
        for group in batches_by(batches, "cell"):
            item = group.column("item").to_numpy()
            size = group.column("size").to_numpy().astype(float)
            # Longest first: long documents are settled by the shorter ones that follow, so the
            # fraction that is left at the end is of a short one. The order depends on the rows alone.
            order = np.lexsort((item, -size))
            part = group.column("part").to_numpy().astype(float)[order]
            draw = _draw(seed + level, item[order])
            left = pivotal(size[order], part, draw.random(len(part)))
            if left >= 0 and last:
                part[left] = float(part[left] >= 0.5)
            yield pa.RecordBatch.from_arrays(
                [
                    *(_taken(group.column(c), order) for c in ("doc_id", "source", "item", "size")),
                    pa.array(part),
                ],
                names=["doc_id", "source", "item", "size", "part"],
            )

    return run


def copies(items: DataFrame, shares: DataFrame, seed: int = 17) -> DataFrame:
    """Rows (doc_id, source, copies) for items (doc_id, source, size), unique by id and source.

    A level deals the open fractions of a source over groups of about ``GROUP`` by
    a hash of the item, so a source of any size is spread over many groups, and leaves one
    fraction per group. The last level has all leftovers of a source in one group.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = shares.select(F.col("source").alias("_source"), rate.alias("rate"), "n_items")
    # One row per source: the join carries no more than that to each task.
    open_items = items.join(rated, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor(F.col("rate")).cast("int")
    # Documents without words change nothing; they are taken at the rounded rate.
    fraction = F.when(F.col("size") > 0, F.col("rate") - whole).otherwise(0.0)
    # The hash orders and draws; it decides nothing by itself if two items should share it.
    item = F.xxhash64(F.lit(seed), "doc_id", F.col("doc_id").isNull())
    columns = ["doc_id", "source", "item", "size", "part"]
    now = open_items.select(
        "doc_id", "source", item.alias("item"), "size", fraction.alias("part"), "n_items"
    )
    largest = shares.agg(F.max("n_items")).first()[0] or 0
    done, level = [], 0
    while True:
        groups = max(1, -(-largest // GROUP))
        last = groups == 1
        cells = F.ceil(F.col("n_items") / GROUP).cast("long")
        cell = F.xxhash64(
            F.lit(level), "source", F.pmod(F.xxhash64(F.lit(level), "item"), cells)
        )
        run = stored(
            now.withColumn("cell", cell)
            .select("cell", *columns)
            .repartition("cell")
            .sortWithinPartitions("cell")
            .mapInArrow(
                _round_groups(seed, level, last),
                "doc_id long, source string, item long, size long, part double",
            ),
            "rounding",
        )
        done.append(run.filter("part <= 0 or part >= 1"))
        if last:
            break
        largest, level = groups, level + 1
        counts = run.filter("part > 0 and part < 1").groupBy("source").agg(F.count("*").alias("n_items"))
        counts = counts.withColumnRenamed("source", "_source")
        now = (
            run.filter("part > 0 and part < 1")
            .join(counts, F.col("source").eqNullSafe(F.col("_source")))
            .drop("_source")
        )
    rounded = done[0]
    for frame in done[1:]:
        rounded = rounded.unionByName(frame)
    return rounded.join(rated.drop("n_items"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", (F.col("part").cast("int") + whole).alias("copies")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 17,
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken), one per row of ``docs``.

    Size is the number of words, 0 for null and blank texts, which are taken like the
    whole part of their source's rate. Rows that agree in doc_id and source, also those without
    doc_id, are decided together and taken equally often, which counts all their words. A
    null source is a source of its own, ordered last. The same rows give the same
    mix, whatever their order or partitions. Other columns are not read.
    """
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size")
        ),
        "sizes",
    )
    items = stored(sized.groupBy("doc_id", "source").agg(F.sum("size").alias("size")), "items")
    shares = stored(targets(items, weights, most), "targets")
    by_item = copies(items, shares, seed).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_from"), "copies"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_from"))
    totals = shares.select(F.col("source").alias("_of"), "source_size", "target")
    return (
        sized.join(by_item, same)
        .drop("_id", "_from")
        .join(totals, F.col("source").eqNullSafe(F.col("_of")))
        .drop("_of")
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns."""
    chosen = (
        mix(docs.select("doc_id", "source", "text"), **options)
        .groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_from"))
        .agg(F.first("copies").alias("_mix_copies"))
        .filter("_mix_copies > 0")
    )
    same = docs["doc_id"].eqNullSafe(F.col("_mix_id")) & docs["source"].eqNullSafe(
        F.col("_mix_from")
    )
    repeats = F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy")
    return docs.join(chosen, same).select(*[docs[c] for c in docs.columns], repeats).drop("_mix_copy")
