"""The registered query of each training-data operator, over its whole table."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from lading.llm import (
    divergence,
    embeddings,
    extraction,
    mixing,
    neighbours,
    packing,
    passages,
    periodic,
    sharding,
    simhash,
    surrogates,
    toxicity,
    warc,
)
from lading.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.packed(table(spark, sf_dir, "documents"), TOKENIZER)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replaced(table(spark, sf_dir, "documents"), counted="n_replaced")
    return replaced.select("doc_id", "text", "n_replaced")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(spark, table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


@query
def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = passages.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.placed(table(spark, sf_dir, "documents"), n_shards=8)
    return dealt.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source"
    )


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document as the query looks at them: a tenth end in a passage that repeats."""
    drawn = 1 if doc_id is None else crc32(str(doc_id).encode())
    if drawn % 10 or not words:
        return words
    g, n = drawn // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + period]
    return words[:a] + (unit * ((n - a) // period + 1))[: n - a]


@query
def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), prepare=planted_repeats)
    best = periodic.strongest(F.col("runs"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
