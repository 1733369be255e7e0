from collections import Counter
from hashlib import md5
from zlib import crc32

import pytest

from lading.llm import sharding

from .edge import documents


def plain(rows, n_shards, seed=sharding.SEED):
    """(doc_id, source, size, crc, shard, slot) by ranking in one place."""
    sized = []
    for doc_id, source, text in rows:
        raw = (text or "").encode()
        draw = int(md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)
        low = (draw, doc_id is not None, doc_id or 0, crc32(raw), len(raw) + 1)
        sized.append((source, low, doc_id))
    strata = {}
    for source, low, doc_id in sized:
        strata.setdefault(source, []).append((low, doc_id))
    order = []
    for source, members in strata.items():
        for rank, (low, doc_id) in enumerate(sorted(members, key=lambda m: m[0])):
            named = (source is not None, (source or "").encode())
            order.append(((2 * rank + 1) / (2 * len(members)), named, low, doc_id, source))
    placed, total = [], len(order)
    for at, (_, _, low, doc_id, source) in enumerate(sorted(order, key=lambda o: o[:3])):
        shard = at * n_shards // total
        placed.append((doc_id, source, low[4], low[3], shard, at - -(-shard * total // n_shards)))
    return placed


COLUMNS = ["doc_id", "source", "size", "text_crc32", "shard", "slot"]


@pytest.mark.parametrize("n_shards", [8, 3])
def test_against_plain_ranking(spark, data, n_shards):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    found = sharding.placed(docs, n_shards)
    assert sorted(map(repr, map(tuple, found.select(COLUMNS).collect()))) == sorted(map(repr, plain(rows, n_shards)))
    again = sharding.placed(docs.repartition(7), n_shards)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found.collect()))


def test_every_shard_holds_the_mixture(spark):
    # Two thirds of the rows are one text of one source.
    rows = [(i, "same text" if i % 3 else f"text {i}", "en", "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    found = sharding.placed(documents(spark, rows)).collect()
    shards = Counter(r["shard"] for r in found)
    assert set(shards) == set(range(8)) and max(shards.values()) - min(shards.values()) <= 1
    for shard, size in shards.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(size))
    whole = Counter(r["source"] for r in found)
    for (source, _), n in Counter((r["source"], r["shard"]) for r in found).items():
        assert abs(n - whole[source] / 8) <= 2
    # Within a source the order is a draw, not that of the ids.
    first = [r["doc_id"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"])) if r["source"] == "hot"]
    assert first != sorted(first)
    other = sharding.placed(documents(spark, rows), seed=1).collect()
    assert {(r["doc_id"], r["slot"]) for r in other} != {(r["doc_id"], r["slot"]) for r in found}


def test_edge_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    found = sharding.placed(docs)
    assert sorted(map(repr, map(tuple, found.select(COLUMNS).collect()))) == sorted(map(repr, plain(rows, 8)))
    assert {(r["law"], r["grown_shard"]) for r in found.collect()} == {("rows", None)}
    assert {(r["size"], r["text_crc32"]) for r in found.collect() if r["doc_id"] in (3, 4)} == {(1, 0)}
    assert sharding.placed(documents(spark, [])).collect() == []
    # Fewer rows than shards: some shards stay empty.
    few = sharding.placed(documents(spark, [(1, "a", "en", "x"), (2, "b", "en", "x")])).collect()
    assert [r["slot"] for r in few] == [0, 0] and len({r["shard"] for r in few}) == 2
    with pytest.raises(ValueError):
        sharding.interleaved(docs.withColumnRenamed("lang", "_share"), 8)


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i}", "en", f"s{i % 5}") for i in range(500)]
    docs = documents(spark, rows)
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(back.columns) == sorted([*docs.columns, "shard", "slot"])
    placed = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.placed(docs, 4).collect()}
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == placed
    assert back.select("doc_id", "text").subtract(docs.select("doc_id", "text")).count() == 0
