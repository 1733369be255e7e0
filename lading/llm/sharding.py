"""Shards that all hold the mixture of the sources, by proportional stratified interleaving.

Within each source rows are shuffled by a seeded draw and ranked. A row's fractional rank is its
rank over the size of its source; in the order of fractional ranks every stretch holds
the sources in proportion, so that order is cut into shards of equal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import numbered, stored

# Fixed value: what the shards are equal in.
LAW = "rows"

SEED = 23

# Hex digits of the digest that make the draw.
DRAW_DIGITS = 15


def draw(key: Column, seed: int) -> Column:
    """A number from the seed and the row's key; null keys draw alike."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, DRAW_DIGITS), 16, 10).cast("long")


def interleaved(
    rows: DataFrame,
    n_shards: int,
    stratum: str = "source",
    key: str = "doc_id",
    ties: tuple[str, ...] = (),
    seed: int = SEED,
) -> DataFrame:
    """Add ``shard``, from 0, and ``slot``, the place in the shard without gaps from 0.

    Shards differ by one row at most, and of every stratum a shard holds its share up to two rows.
    Rows of a stratum come in the order of a draw from ``key``, then by ``key`` and ``ties``; rows that agree
    in all of these change nothing but their own places. A null stratum is one of its own, and null keys
    are keys like any other. The rows are range-partitioned by draw and by fractional rank, so that a
    stratum of any size is spread over many tasks; all columns of ``rows`` go
    through these two shuffles, so keep wide ones out. Columns named shard or slot are replaced.
    """
    own = ["_draw", "_place", "_of", "_first", "_n", "_share", "_position", "_slot", "_part", "_at", "_before"]
    if clash := set(own) & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are used by the interleaving")
    drawn = rows.drop("shard", "slot").withColumn("_draw", draw(F.col(key), seed))
    order = [stratum, "_draw", key, *ties]
    ranked = numbered(stored(drawn, "drawn"), order, "ranked", "_place")
    strata = stored(
        ranked.groupBy(F.col(stratum).alias("_of")).agg(
            F.min("_place").alias("_first"), F.count("*").alias("_n")
        ),
        "strata",
    )
    # One row per stratum: nothing is multiplied, and a stratum with very many rows can be split.
    shared = ranked.join(strata, F.col(stratum).eqNullSafe(F.col("_of"))).withColumn(
        "_share", (2 * (F.col("_place") - F.col("_first")) + 1) / (2 * F.col("_n"))
    )
    mixed = numbered(shared.drop("_place", "_of", "_first", "_n"), ["_share", *order], "mixed", "_position")
    total = int(strata.agg(F.sum("_n")).first()[0] or 0)
    # Shard s holds the positions from the s-th part of all rows on, rounded up.
    return (
        mixed.withColumn("shard", F.expr(f"cast((_position * {n_shards}) div {max(1, total)} as int)"))
        .withColumn("slot", F.expr(f"_position - (shard * {total}L + {n_shards - 1}) div {n_shards}"))
        .drop("_draw", "_share", "_position")
    )


def documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, size, text_crc32): what is needed of documents to deal them out.

    Size is the text's length in UTF-8 bytes plus 1; a null text counts like an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def placed(docs: DataFrame, n_shards: int = 8, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, source, size, text_crc32, law, shard, slot, grown_shard), one per document.

    Equal texts are rows like any other: a text of which a third of all rows are copies cannot
    stay in one of equal shards. Rows that repeat in all that is read take neighbouring places among themselves.
    Null and empty texts have size 1. No shard is grown under this law. Other columns are not read.
    """
    dealt = interleaved(documents(docs), n_shards, ties=("text_crc32", "size"), seed=seed)
    return dealt.withColumns({"law": F.lit(LAW), "grown_shard": F.lit(None).cast("int")})


def write_shards(docs: DataFrame, path: str, n_shards: int, seed: int = SEED) -> None:
    """Write the rows of ``docs``, unique by doc_id, as one folder per shard, each in the order of its slots.

    Places are worked out from narrow rows; the texts are read once more and shuffled once, to where they
    are written. The columns shard and slot are added. The shards' mixture is that of ``placed``.
    """
    at = placed(docs, n_shards, seed).select(F.col("doc_id").alias("_id"), "shard", "slot")
    whole = docs.drop("shard", "slot").join(at, docs["doc_id"].eqNullSafe(F.col("_id"))).drop("_id")
    ordered = whole.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
