"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, and several Hilbert curves, each over its own
projection and shift, put them in order. Spark range-partitions each order; a query is
compared with the window of rows around its place on every curve, and the windows' best are
merged and reranked on the original vectors.

What windows alone would miss is settled along the first curve: it is cut into cells, each
with a centre and a radius, and a query goes on to every cell that could still hold a nearer
vector than the worst it has. On data with structure few cells remain; on data without
any, none can be ruled out and the search is complete but not cheaper than comparing all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.llm.common import carried, in_order, numbered, stored
from lading.llm.embeddings import usable

CURVES = 6
DIMENSIONS = 8
BITS = 7
WINDOW = 256
SEED = 42

CELL = 1024
QUERY_BLOCK = 256
HEADS = 256


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points with ``bits`` bits a coordinate.

    The transposed form of the place is found by undoing the curve's rotations bit by bit, for
    all points at once; its bits are then interleaved.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of vectors that all have ``width`` components."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def lengths(rows: np.ndarray) -> np.ndarray:
    """Lengths of the rows; squares of very large or small components neither overflow nor vanish."""
    top = np.abs(rows).max(axis=1, initial=0.0)
    scaled = rows / np.where(top > 0, top, 1.0)[:, None]
    return top * np.sqrt((scaled**2).sum(axis=1))


def _curve_rows(curves: int, longest: float):
    """Rows (size, curve, key, vec_id, asks, vector) on every curve.

    The largest inner product becomes the least distance by one more coordinate, which fills
    every candidate up to the longest vector's length; queries, at length one, have none there.
    """

    def run(batches):
        frames: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            asks = batch.column(3).to_numpy(zero_copy_only=False)
            for width in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == width)
                ids, vectors = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
                rows = matrix(vectors, width)
                norm = lengths(rows)
                asked = asks[at]
                scale = np.where(asked, norm, longest)[:, None]
                rest = np.where(asked, 0.0, np.sqrt(np.maximum(0.0, 1 - (norm / longest) ** 2)))
                points = np.concatenate([rows / scale, rest[:, None]], axis=1)
                if width not in frames:
                    rng = np.random.default_rng([SEED, width])
                    kept = min(DIMENSIONS, width + 1)
                    frames[width] = [
                        (
                            np.linalg.qr(rng.standard_normal((width + 1, kept)))[0],
                            rng.random(kept) * 0.5,
                        )
                        for _ in range(curves)
                    ]
                for number, (frame, shift) in enumerate(frames[width]):
                    # Coordinates of unit vectors are small in many dimensions: stretch them.
                    spread = (points @ frame) * np.sqrt(width + 1) / 4
                    grid = (np.clip(spread, -1, 1) + 1) / 2.5 + shift / 2.5
                    cells = np.minimum((grid * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                    key = hilbert_keys(cells, BITS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), width, np.int32)),
                            pa.array(np.full(len(at), number, np.int32)),
                            pa.array(key),
                            ids,
                            pa.array(asked),
                            vectors,
                        ],
                        names=["size", "curve", "key", "vec_id", "asks", "vector"],
                    )

    return run


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the components.

    Equal vectors get equal scores, wherever they are compared.
    """
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * rows[:, i]
    return total


class Best:
    """The best ``k`` (score, vec_id) of each query seen so far, ties to smaller ids."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((query, vec, score))
        self.size += len(query)
        if self.size > 400_000:
            self.trim()

    def trim(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, vec, score = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        # A pair may come from several windows; it has the same score in each.
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        fresh = np.ones(len(query), bool)
        fresh[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]) | (score[1:] != score[:-1])
        query, vec, score = query[fresh], vec[fresh], score[fresh]
        starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else []
        rank = np.arange(len(query)) - np.repeat(starts, np.diff([*starts, len(query)]))
        keep = rank < self.k
        self.parts = [(query[keep], vec[keep], score[keep])]
        self.size = int(keep.sum())
        return self.parts[0]

    def batch(self) -> pa.RecordBatch:
        query, vec, score = self.trim()
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
            names=["query_id", "vec_id", "score"],
        )


def _promising(scores: np.ndarray, floor: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be among a query's best: rounding is allowed for by ``slack``."""
    if scores.shape[1] > k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        floor = np.maximum(floor, kth)
    return np.nonzero((scores >= (floor - slack)[:, None]) & (scores > -np.inf))


def _window_best(k: int, window: int):
    def run(batches):
        best = Best(k)
        for piece, count in carried(batches, window, 2048):
            order = piece.column("curve").to_numpy().astype(np.int64) << 32 | piece.column("size").to_numpy()
            ids, asks = piece.column("vec_id").to_numpy(), piece.column("asks").to_numpy(zero_copy_only=False)
            vectors = piece.column("vector").combine_chunks()
            edges = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1], [True]]))
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                rows = matrix(vectors.slice(start, stop - start), int(order[start] & 0xFFFFFFFF))
                places = np.flatnonzero(asks[start:stop])
                data = np.flatnonzero(~asks[start:stop])
                norm = lengths(rows)
                for at in range(0, len(places), 64):
                    some = places[at : at + 64]
                    low, high = some[0] - window, some[-1] + window
                    near = data[(data >= low) & (data <= high)]
                    scores = rows[some] @ rows[near].T
                    away = np.abs(some[:, None] - near[None, :])
                    # A pair belongs to the piece in which its first row is new.
                    first = np.minimum(some[:, None], near[None, :]) + start
                    own = ids[start + some][:, None] == ids[start + near][None, :]
                    scores[(away > window) | (first >= count) | own] = -np.inf
                    slack = 1e-10 * norm[some] * (norm[near].max() if len(near) else 0)
                    a, b = _promising(scores, np.full(len(some), -np.finfo(float).max), k, slack)
                    score = exact_scores(rows[some[a]], rows[near[b]])
                    best.add(ids[start + some[a]], ids[start + near[b]], score)
        yield best.batch()

    return run


def _cells(batches):
    """Packs consecutive rows of the first curve: ids, vectors, centre and radius of each cell."""
    task, number = TaskContext.get().partitionId(), 0
    held = None

    def packed(part):
        nonlocal number
        width = part.column("size")[0].as_py()
        rows = matrix(part.column("vector"), width)
        centre = rows.mean(axis=0)
        radius = float(lengths(rows - centre).max())
        number += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 33) + number - 1], pa.int64()),
                pa.array([width], pa.int32()),
                pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([rows.ravel()], pa.list_(pa.float64())),
                pa.array([centre], pa.list_(pa.float64())),
                pa.array([radius], pa.float64()),
            ],
            names=["cell", "size", "ids", "vectors", "centre", "radius"],
        )

    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
        while held.num_rows:
            sizes = held.column("size").to_numpy()
            end = int(np.argmax(sizes != sizes[0])) if (sizes != sizes[0]).any() else len(sizes)
            if end < CELL and end == len(sizes):
                break
            yield packed(held.slice(0, min(end, CELL)))
            held = held.slice(min(end, CELL))
    if held is not None and held.num_rows:
        yield packed(held)


def _possible(batches):
    """(block, cell) for the cells that may hold a better vector for a query of the block."""
    for batch in batches:
        blocks, cells = [], []
        for i in range(batch.num_rows):
            width = batch.column("size")[i].as_py()
            heads = batch.column("heads")[i].values
            queries = batch.column("queries")[i].values.to_numpy().reshape(-1, width)
            floor = batch.column("floors")[i].values.to_numpy()
            centres = heads.field("centre").flatten().to_numpy().reshape(-1, width)
            norm = lengths(queries)
            most = queries @ centres.T + norm[:, None] * heads.field("radius").to_numpy()[None, :]
            slack = 1e-9 * (1 + np.abs(most))
            # What overflows rules nothing out.
            open_ = ~(most + slack < floor[:, None]).all(axis=0)
            found = heads.field("cell").to_numpy()[open_]
            cells.append(found)
            blocks.append(np.full(len(found), batch.column("block")[i].as_py()))
        if blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(blocks), pa.int64()), pa.array(np.concatenate(cells), pa.int64())],
                names=["block", "cell"],
            )


def _cell_best(k: int):
    def run(batches):
        best: dict[int, Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                width = batch.column("size")[i].as_py()
                queries = batch.column("queries")[i].values.to_numpy().reshape(-1, width)
                rows = batch.column("vectors")[i].values.to_numpy().reshape(-1, width)
                asked, ids = (batch.column(c)[i].values.to_numpy() for c in ("asked", "ids"))
                floor = batch.column("floors")[i].values.to_numpy()
                scores = queries @ rows.T
                scores[asked[:, None] == ids[None, :]] = -np.inf
                norm = lengths(queries)
                slack = 1e-10 * norm * lengths(rows).max()
                a, b = _promising(scores, np.maximum(floor, -np.finfo(float).max), k, slack)
                score = exact_scores(queries[a], rows[b])
                best.setdefault(batch.column("block")[i].as_py(), Best(k)).add(asked[a], ids[b], score)
        for found in best.values():
            yield found.batch()

    return run


_RESULT = "query_id long, vec_id long, score double"


def on_curves(given: DataFrame, curves: int) -> DataFrame:
    """The vectors on the first ``curves`` curves, queries a second time as such."""
    size = F.transform("vector", lambda x: F.abs(x.cast("double")))
    top = F.array_max(size)
    shares = F.aggregate(size, F.lit(0.0), lambda s, x: s + (x / top) * (x / top))
    longest = given.agg(F.max(top * F.sqrt(shares))).first()[0]
    # Every vector is offered; the queries have a second row that asks.
    both, one = F.array(F.lit(False), F.lit(True)), F.array(F.lit(False))
    roles = given.withColumn("asks", F.explode(F.when(F.col("asks"), both).otherwise(one)))
    kind = given.schema["vector"].dataType.simpleString()
    return roles.select("vec_id", "vector", "size", "asks").mapInArrow(
        _curve_rows(curves, float(longest or 1.0)),
        f"size int, curve int, key long, vec_id long, asks boolean, vector {kind}",
    )


def window_search(given: DataFrame, k: int, curves: int, window: int) -> DataFrame:
    """Candidates (query_id, vec_id, score) from the windows around each query on every curve."""
    rows = on_curves(given, curves)
    ordered = in_order(rows, ["size", "curve", "key", "vec_id"], given.count() * curves)
    return stored(ordered.mapInArrow(_window_best(k, window), _RESULT), "windows")


def search(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    curves: int = CURVES,
    window: int = WINDOW,
    complete: bool = True,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another
    vec_id and as many components. Ties go to the smaller vec_id. Vectors that are null, empty, zero or
    hold a null or non-finite component take no part, nor do rows without vec_id. Of
    rows that repeat a vec_id each is asked and offered, the best pair counts. Extra columns
    are not read. ``complete=False`` returns what the windows alone find.
    """
    given = usable(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector")).filter(
            "vec_id is not null"
        ),
        "vector",
    ).select("vec_id", "vector", F.size("vector").alias("size"), (F.col("vec_id") % every == 0).alias("asks"))
    given = stored(given, "vectors")
    near = window_search(given, k, curves, window)
    found = near
    if complete:
        found = near.unionByName(_remaining(given, near, k))
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # A query has at most k candidates from each task.
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        pairs.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def _remaining(given: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """Candidates from all cells of the first curve that the windows' results do not rule out."""
    first = stored(on_curves(given, 1), "first-curve")
    n_rows = given.count()
    cells = stored(
        in_order(first.filter("not asks"), ["size", "key", "vec_id"], n_rows).mapInArrow(
            _cells,
            "cell long, size int, ids array<long>, vectors array<double>, centre array<double>, radius double",
        ),
        "cells",
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = (
        near.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("place", place)
        .filter(F.col("place") == k)
        .select("query_id", F.col("score").alias("floor"))
    )
    asked = (
        given.filter("asks")
        .join(floors, F.col("vec_id") == F.col("query_id"), "left")
        .select("size", "vec_id", "vector", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    )
    asked = stored(asked, "queries")
    # Queries that are near each other on the curve share a block: they rule out the same cells.
    on_curve = first.filter("asks").select(F.col("vec_id").alias("_id"), "key").distinct()
    placed = numbered(
        asked.join(on_curve, F.col("vec_id") == F.col("_id")).drop("_id"),
        ["size", "key", "vec_id"],
        "asked",
    )
    blocks = stored(
        placed.withColumn("block", F.floor(F.col("place") / QUERY_BLOCK) * (1 << 16) + F.col("size"))
        .groupBy("block", "size")
        .agg(F.collect_list(F.struct("vec_id", "vector", "floor")).alias("all"))
        .select(
            "block",
            "size",
            F.col("all.vec_id").alias("asked"),
            F.flatten(F.transform("all", lambda r: r["vector"].cast("array<double>"))).alias("queries"),
            F.col("all.floor").alias("floors"),
        ),
        "query-blocks",
    )
    n_heads = max(1, -(-cells.count() // HEADS))
    heads = (
        cells.select(
            "size",
            F.pmod(F.xxhash64("cell"), F.lit(n_heads)).alias("part"),
            F.struct("cell", "centre", "radius").alias("head"),
        )
        .groupBy("size", "part")
        .agg(F.collect_list("head").alias("heads"))
    )
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_heads - 1).cast("long")))
    open_pairs = stored(
        blocks.withColumn("part", parts)
        .join(heads, ["size", "part"])
        .mapInArrow(_possible, "block long, cell long"),
        "pairs",
    )
    return (
        open_pairs.join(blocks, "block")
        .join(cells.select("cell", "ids", "vectors"), "cell")
        .mapInArrow(_cell_best(k), _RESULT)
    )
