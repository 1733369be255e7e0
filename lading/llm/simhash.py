"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint's Hamming distances to a fixed set of reference fingerprints (the
pivots) are computed once. Two fingerprints within ``radius`` bits have distances
to every pivot that differ by no more than ``radius``: pairs with a larger
difference in any coordinate are discarded, the survivors are compared.

The pivots are the zero fingerprint and one fingerprint per block of two bits.
Distance to zero and distance to a block's pivot give the number of bits set in
that block, so a flipped bit changes one block's number only. With ``radius + 2``
groups of blocks, two fingerprints within ``radius`` bits agree in all numbers of
at least two groups; those numbers are the join key, and no pair is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import components, stored

# Seed of the shingle hash, bits of a fingerprint.
SEED = 42
BITS = 64
BLOCK_BITS = 2

# Keys with more fingerprints than this are linked through shared midpoints instead of pairs.
BUCKET_LIMIT = 256

# Shingles that are counted at a time.
COUNT_CHUNK = 1 << 18

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    # bytes.split() without an argument splits at exactly the six ASCII white-space bytes.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle_words:
        starts = starts[: len(words) - shingle_words + 1]
        ends = ends[shingle_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    return np.array([digest(view[i:j], SEED) for i, j in spans], "<u8")


def majority(hashes: np.ndarray) -> bytes:
    """Eight bytes, little-endian: the bits that are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNT_CHUNK):
        some = hashes[at : at + COUNT_CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes()


def fingerprint(text: str | None, shingle_words: int) -> int:
    """SimHash of one text over its word shingles; zero without words."""
    return int.from_bytes(majority(shingle_hashes(text, shingle_words)), "little")


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint of every text as a signed long."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def pivots() -> list[int]:
    """The zero fingerprint, then one with all bits of a block set, as signed longs."""
    blocks = [((1 << BLOCK_BITS) - 1) << at for at in range(0, BITS, BLOCK_BITS)]
    return [v - (1 << BITS) if v >> (BITS - 1) else v for v in [0, *blocks]]


def distance_table(fps: DataFrame) -> DataFrame:
    """Add the Hamming distances of ``fp`` to every pivot."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()]
    return fps.withColumn("distances", F.array(*distances))


def _keys(distances: Column, radius: int) -> Column:
    """One key per pair of groups: the group numbers and the bits set in each of their blocks."""
    blocks = BITS // BLOCK_BITS
    groups = [list(range(g, blocks, radius + 2)) for g in range(radius + 2)]
    made = []
    for number, chosen in enumerate(combinations(range(radius + 2), 2)):
        key = F.lit(number).cast("long")
        for block in sorted(groups[chosen[0]] + groups[chosen[1]]):
            # distance to zero minus distance to the block's pivot is 2 x set bits - block size
            bits = (distances[0].cast("int") - distances[block + 1] + BLOCK_BITS) / 2
            key = key * (BLOCK_BITS + 1) + bits.cast("long")
        made.append(key)
    return F.array(*made)


def _verified(a: str, b: str, radius: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (src, dst) that connect all distinct fingerprints within ``radius`` bits.

    ``fps`` has distinct ``fp`` and their smallest document ``first_doc``. Pairs are made
    only in keys of at most ``BUCKET_LIMIT`` fingerprints. In larger ones each fingerprint is
    joined to its midpoints, the fingerprints half the radius away: two that are within the
    radius share one, and any that share one are within the radius. Each midpoint yields
    a star, so the work follows the number of rows; this, too, loses nothing.
    """
    if radius != 2:
        raise ValueError("the midpoints are worked out for a radius of two bits")
    table = stored(distance_table(fps), "pivots")
    keyed = table.select("fp", F.explode(_keys(F.col("distances"), radius)).alias("key"))
    sizes = keyed.groupBy("key").count().filter("count > 1")
    busy = stored(keyed.join(sizes, "key"), "keys")
    small = (
        busy.filter(F.col("count") <= BUCKET_LIMIT)
        .select("key", "fp")
        .join(table.select("fp", "first_doc", "distances"), "fp")
    )
    small = stored(small, "candidates")
    left = small.select("key", *[F.col(c).alias(f"{c}_a") for c in ("fp", "first_doc", "distances")])
    right = small.select("key", *[F.col(c).alias(f"{c}_b") for c in ("fp", "first_doc", "distances")])
    near = F.array_max(
        F.zip_with("distances_a", "distances_b", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    )
    pairs = (
        left.join(right, "key")
        .filter(F.col("fp_a") < F.col("fp_b"))
        .filter(near <= radius)
        .filter(_verified("fp_a", "fp_b", radius))
        .select(F.col("first_doc_a").alias("src"), F.col("first_doc_b").alias("dst"))
    )
    one_bit = F.array(*[F.lit(b - (1 << BITS) if b >> (BITS - 1) else b) for b in (1 << i for i in range(BITS))])
    crowded = busy.filter(F.col("count") > BUCKET_LIMIT).select("fp").distinct()
    middles = (
        crowded.join(table.select("fp", "first_doc"), "fp")
        .select(
            "first_doc",
            F.explode(
                F.concat(
                    F.array("fp"), F.transform(one_bit, lambda bit: F.col("fp").bitwiseXOR(bit))
                )
            ).alias("middle"),
        )
    )
    middles = stored(middles, "midpoints")
    least = middles.groupBy("middle").agg(F.min("first_doc").alias("dst"), F.count("*").alias("n"))
    stars = (
        middles.join(least.filter("n > 1"), "middle")
        .select(F.col("first_doc").alias("src"), "dst")
        .filter("src <> dst")
    )
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """Rows (doc_id, fp, component_id): one per row of ``docs``.

    Documents whose fingerprints are linked, directly or over others, have the
    smallest doc_id among them as component. Null, empty and blank texts have
    fingerprint zero and link like any other. Rows without doc_id keep their
    fingerprint, are linked with nothing and have no component; a repeated doc_id
    belongs to all its rows, so its fingerprints are one component. Columns
    of ``docs`` other than doc_id and text are not read.
    """
    marked = stored(fingerprints(docs, shingle_words), "fingerprints")
    known = marked.filter("doc_id is not null")
    distinct = stored(known.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    # The same id under several fingerprints ties these together.
    repeated = known.groupBy("doc_id").agg(
        F.min("fp").alias("low"), F.max("fp").alias("high")
    ).filter("low <> high").select("doc_id")
    ties = (
        known.join(repeated, "doc_id")
        .join(distinct, "fp")
        .select(F.col("doc_id").alias("src"), F.col("first_doc").alias("dst"))
    )
    found = components(links(distinct, radius).unionByName(ties.filter("src <> dst")), "simhash")
    classes = distinct.join(found, F.col("first_doc") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "first_doc").alias("component_id")
    )
    return known.join(stored(classes, "classes"), "fp").unionByName(
        marked.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    )


def representatives(docs: DataFrame, shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the smallest doc_id stays.

    Rows without doc_id are kept, and all rows of an id that stays.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), shingle_words, radius)
    away = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_dup_id"))
    return docs.join(away, docs["doc_id"] == F.col("_dup_id"), "left_anti")
