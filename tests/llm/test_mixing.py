import numpy as np

from lading.llm import mixing
from lading.llm.queries import QUERIES

from .edge import documents


def targets(sizes, most=3):
    """Targets by sharing the excess again and again; ``sizes`` in order of the sources."""
    weight = [i % 3 + 1 for i in range(len(sizes))]
    total, full = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in full)
        free = [i for i in range(len(sizes)) if i not in full]
        share = left / sum(weight[i] for i in free) if free else 0
        over = {i for i in free if weight[i] * share > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in full else weight[i] * share for i in range(len(sizes))]
        full |= over


def test_pivotal_keeps_words_and_rounds():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(1, 500, 200).astype(float)
        part = np.full(200, rng.random())
        before = (sizes * part).sum()
        left = mixing.pivotal(sizes, part, rng.random(200))
        assert abs((sizes * part).sum() - before) < 1e-6
        open_ = np.flatnonzero((part > 0) & (part < 1))
        assert open_.tolist() == ([left] if left >= 0 else [])


def test_pivotal_keeps_expectations():
    rng = np.random.default_rng(1)
    sizes = np.array([5.0, 50.0, 20.0, 1.0, 300.0])
    mean = np.zeros(5)
    for _ in range(20_000):
        part = np.full(5, 0.3)
        mixing.pivotal(sizes, part, rng.random(5))
        mean += part
    assert np.abs(mean / 20_000 - 0.3).max() < 0.02


def test_query_on_whole_table(spark, data):
    rows = QUERIES["op4_mixing"](spark, data).collect()
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    size = {d["doc_id"]: len(d["text"].encode().split()) for d in docs}
    assert {r["doc_id"]: r["size"] for r in rows} == size and len(rows) == len(docs)
    sources = sorted({d["source"] for d in docs})
    sums = [sum(size[d["doc_id"]] for d in docs if d["source"] == s) for s in sources]
    for source, total, target in zip(sources, sums, targets(sums), strict=True):
        mine = [r for r in rows if r["source"] == source]
        assert {r["source_size"] for r in mine} == {total}
        assert all(abs(r["target"] - target) < 1e-6 * target for r in mine)
        # All but one document a source keep its words; that one is off by half its size at most.
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine) / 2 + 1e-6
        rate = target / total
        assert all(r["copies"] in (int(rate), int(rate) + 1) and r["taken"] <= 3 * r["size"] for r in mine)


def test_large_sources_come_near(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    sums = rows.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert len(sums) == 20 and all(abs(r["sum(taken)"] - r["max(target)"]) < 0.01 * r["max(target)"] for r in sums)


def test_same_mix_whatever_the_partitions(spark, data, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 7)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    one = mixing.mix(docs).select("doc_id", "copies")
    other = mixing.mix(docs.repartition(5)).select("doc_id", "copies")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns
    assert whole.count() == sum(r["copies"] for r in one.collect())


def test_small_sources_stop_at_three_times(spark):
    rows = [(i, "a b c d", "en", "big") for i in range(300)] + [(1000 + i, "a b", "en", "small") for i in range(3)]
    found = {r["source"]: r["target"] for r in mixing.mix(documents(spark, rows)).collect()}
    assert found == {"big": 1206 - 18, "small": 18.0}


def test_edge_rows(spark):
    rows = mixing.mix(documents(spark)).collect()
    assert len(rows) == 13
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert len({r["copies"] for r in rows if r["doc_id"] == 2}) == 1
    empty = documents(spark, [])
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).collect() == []
    blank = documents(spark, [(1, None, None, None), (2, "", None, "a")])
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
    assert mixing.mixed(documents(spark)).columns == documents(spark).columns
