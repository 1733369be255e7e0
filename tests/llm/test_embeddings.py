import math

import numpy as np
import pyarrow as pa
import pytest

from lading.llm import embeddings
from lading.llm.embeddings import unit_rows
from lading.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, component long, size string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "s") for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    root = {i: i for i, _ in rows if i is not None}
    links = dict.fromkeys(root, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(good)):
        for b in range(a):
            (i, u), (j, v) = good[a], good[b]
            if len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, links[i], find(i), find(i) == i) for i in root)


def clustered(rng, n, size=16):
    rows = []
    for _ in range(n):
        centre = rng.standard_normal(size)
        for _ in range(int(rng.choice([1, 2, 5, 40], p=[0.6, 0.25, 0.1, 0.05]))):
            rows.append((centre + rng.standard_normal(size) * rng.choice([0, 0.05, 0.2])).tolist())
    return [(i, np.float32(v).tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [16_384, 8])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "TILE", 5)
    rows = clustered(np.random.default_rng(2), 150)
    found = sorted(tuple(r) for r in embeddings.near_duplicates(frame(spark, rows).repartition(3)).collect())
    assert found == brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (9, [1.0, 0.0, 0.0]), (10, [1e38, 0.0]), (11, [-1.0, 0.0]), (12, [0.0, 0.0]), (13, [1e-38, 0.0]), (14, [0.0, -0.0]),
        (None, [1.0, 0.0]), (None, None),
    ]
    found = embeddings.near_duplicates(frame(spark, rows)).collect()
    known = sorted(tuple(r) for r in found if r["vec_id"] is not None)
    assert known == brute(rows)
    assert [tuple(r) for r in found if r["vec_id"] is None] == [(None, 0, None, None)] * 2
    assert embeddings.near_duplicates(frame(spark, [])).collect() == []
    again = embeddings.near_duplicates(frame(spark, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])])).collect()
    assert sorted((r["vec_id"], r["component_id"]) for r in again) == [(1, 1), (1, 1), (2, 1)]


def test_many_tasks(spark, monkeypatch):
    # Tasks of few vectors: most pairs are found in other passes, or as crowded ones.
    monkeypatch.setattr(embeddings, "TASK_ROWS", 60)
    rows = clustered(np.random.default_rng(3), 200)
    assert sorted(tuple(r) for r in embeddings.near_duplicates(frame(spark, rows)).collect()) == brute(rows)


def test_signs_of_zero(spark):
    rows = [(1, [1.0, -0.0]), (2, [1.0, 0.0]), (3, [-0.0, 1.0]), (4, [0.0, 1.0]), (5, [0.0, 1.0])]
    assert sorted(tuple(r) for r in embeddings.near_duplicates(frame(spark, rows)).collect()) == brute(rows)


@pytest.mark.parametrize(("n", "task_rows"), [(10_000, 64_000), (6_000, 1_000)])
def test_few_vectors_count_as_crowded(n, task_rows):
    # Random vectors without structure, passes whole or cut into tasks.
    vectors = np.random.default_rng(5).standard_normal((n, 64))
    low = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    column = pa.array(vectors.tolist(), pa.list_(pa.float64()))
    agree, whole, total = 1 - np.arccos(0.95) / np.pi, n <= task_rows, np.zeros(n)
    for number in range(embeddings.n_passes(n, task_rows, 32, agree, 1e-4)):
        key = embeddings._keys(low, [42, 64, number])
        for at in np.array_split(np.argsort(key), 1 if whole else n // task_rows):
            columns = [np.full(len(at), 64 << 32 | number), key[at], at, column.take(pa.array(at))]
            batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["ordering", "key", "rep", "vector"])
            for found in embeddings._window_links(0.95, 32, agree, whole)(iter([batch])):
                if found.num_rows and found.column("bound")[0].is_valid:
                    total[found.column("src").to_numpy()] += found.column("bound").to_numpy()
    assert (total > np.log(1e-4)).mean() < 0.02


def test_unit_rows():
    rows, good = unit_rows(pa.array([[3.0, 4.0], None, [1e300, 1e300], [1.0]], pa.list_(pa.float64())))
    assert good.tolist() == [True, False, True, True]
    assert np.allclose(rows, [[0.6, 0.8], [0, 0], [math.sqrt(0.5)] * 2, [1, 0]])


def test_query_on_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = sorted(tuple(r) for r in QUERIES["op1_embeddings"](spark, data).collect())
    assert found == brute(rows)


@pytest.mark.parametrize(("inner", "n"), [(0.8, 3000), (0.88, 10_000), (0.93, 3000)])
def test_pairs_in_a_dense_group(spark, monkeypatch, inner, n):
    # A cone of vectors with that cosine to each other, and pairs of 0.955 in it.
    monkeypatch.setattr(embeddings, "BLOCK", 4096)
    rng, size = np.random.default_rng(7), 128
    cone = rng.standard_normal(size)
    cone /= np.linalg.norm(cone)

    def away(v):
        w = rng.standard_normal(size)
        w -= (w @ v) * v
        return w / np.linalg.norm(w)

    rows = [math.sqrt(inner) * cone + math.sqrt(1 - inner) * away(cone) for _ in range(n)]
    rows += [0.955 * v + math.sqrt(1 - 0.955**2) * away(v) for v in rows[:300]]
    rows += [rng.standard_normal(size) for _ in range(6000)]
    vectors = np.array([v / np.linalg.norm(v) for v in rows]).astype(np.float32)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    expected = ((unit @ unit.T) >= 0.95).sum(axis=1) - 1
    given = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(given).collect()}
    assert expected.sum() >= 600
    assert [found[i] for i in range(len(rows))] == expected.tolist()
