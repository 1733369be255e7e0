import math

import numpy as np
import pytest

from lading.llm import neighbours
from lading.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, size int, key string, rank long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "k", 2, 3.0) for i, v in rows], SCHEMA)


def brute(rows, every=20, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, u in good:
        if i % every:
            continue
        near = []
        for j, v in good:
            if j != i and len(u) == len(v):
                score = 0.0
                for a, b in zip(u.tolist(), v.tolist(), strict=True):
                    score += a * b
                near.append((-score, j))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def test_hilbert_curve_steps_to_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        keys = neighbours.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@pytest.mark.parametrize("sizes", [(1024, 256, 256), (16, 8, 3)])
def test_against_all_pairs(spark, monkeypatch, sizes):
    for name, size in zip(("CELL", "QUERY_BLOCK", "HEADS"), sizes, strict=True):
        monkeypatch.setattr(neighbours, name, size)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 12)) * rng.uniform(0.2, 3, (30, 1))
    rows = [(i, np.float32(centres[rng.integers(30)] + rng.standard_normal(12) * rng.choice([0, 0.2])).tolist()) for i in range(900)]
    found = neighbours.search(frame(spark, rows).repartition(3), window=40).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_windows_find_neighbours_on_structured_data(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((60, 32))
    rows = [(i, np.float32(centres[i % 60] + rng.standard_normal(32) * 0.1).tolist()) for i in range(3000)]
    found = neighbours.search(frame(spark, rows), window=128, complete=False)
    hits = {(r["query_id"], r["vec_id"]) for r in found.collect()}
    wanted = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(hits & wanted) >= 0.9 * len(wanted)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [2.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (40, [0.0, 0.0]), (60, None), (3, [nan, 1.0]),
        (4, [inf, 1.0]), (80, [1.0, None]), (100, []), (120, [1.0, 2.0, 3.0]), (-20, [-1.0, -1.0]), (None, [1.0, 0.0]), (5, [0.0, -0.0]),
    ]
    found = sorted(tuple(r) for r in neighbours.search(frame(spark, rows)).collect())
    assert found == brute(rows)
    assert neighbours.search(frame(spark, [])).collect() == []
    ties = [(0, [1.0, 0.5])] + [(i, [0.5, 0.25]) for i in range(1, 60)]
    assert sorted(tuple(r) for r in neighbours.search(frame(spark, ties)).collect()) == brute(ties)


def test_components_whose_squares_overflow_or_vanish(spark):
    rows = [(0, [1e200, 1e10]), (1, [1e200, 0.0]), (20, [1e-200, 1e-200]), (2, [1e-190, 0.0]), (40, [3.0, 1e-180]), (3, [0.0, 1e170])]
    assert np.allclose(neighbours.lengths(np.array([r[1] for r in rows])), [1e200, 1e200, 2**0.5 * 1e-200, 1e-190, 3, 1e170])
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in neighbours.search(given).collect()) == brute(rows)


def test_query_on_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = sorted(tuple(r) for r in QUERIES["op9_neighbours"](spark, data).collect())
    assert found == brute(rows)
