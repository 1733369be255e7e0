"""Near-duplicate embeddings by sorted projection passes.

Every pass draws random hyperplanes and orders the vectors by the bits that say on which side of
each they lie. Spark range-partitions that order, which brings near vectors into one task; there
the task orders its vectors again by the bits of fresh hyperplanes, several times, and compares each vector with a
window of neighbours in each of these orderings. Pairs that prove similar are united over all passes. How many passes are
needed follows from the number of vectors, the window and the odds of missing a pair that are accepted. How crowded
a vector is shows in the key bits it shares with the end of its window and with the border of its task; those whose own odds of a
miss are above what is accepted are compared with each other, all pairs of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import Links, batches_by, components, stored

THRESHOLD = 0.95
WINDOW = 32
KEY_BITS = 63
MISS = 1e-4
SEED = 42

# Blocks of one component, or of crowded vectors, that are compared with each other: vectors and bytes at most.
# Every block is sent once per other block, so large ones mean few copies.
BLOCK = 16_384
BLOCK_BYTES = 32 << 20

# Rows of a block that meet the other block at a time.
TILE = 256

# Vectors of a task and their bytes at most, and orderings that it makes of them.
TASK_ROWS = 64_000
TASK_BYTES = 64 << 20
ORDERINGS = 16

# Key bits by which a vector may be more crowded than on average before it counts as crowded, and passes
# for that beyond those that the average vector needs.
SPARE_BITS = 2
SPARE_PASSES = 1.25


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal length scaled to length one in double precision, and which rows are usable.

    Unusable are null and empty vectors, vectors of zeros, and those with a null or
    non-finite component. Scaling by the largest component first keeps squares finite.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
    width = int(lengths.max()) if len(lengths) else 0
    rows = np.zeros((len(vectors), width))
    good = np.zeros(len(vectors), bool)
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(float)
    starts = vectors.offsets.to_numpy()[:-1]
    for size in np.unique(lengths[present]):
        if size == 0:
            continue
        at = np.flatnonzero(present & (lengths == size))
        taken = values[starts[at][:, None] + np.arange(size)]
        top = np.abs(taken).max(axis=1)
        usable = np.isfinite(taken).all(axis=1) & (top > 0)
        taken = np.where(usable[:, None], taken, 0.0) / np.where(usable, top, 1.0)[:, None]
        norm = np.sqrt((taken**2).sum(axis=1))
        rows[at, :size] = taken / np.where(usable, norm, 1.0)[:, None]
        good[at] = usable
    return rows, good


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector takes part; decided with SQL functions alone."""
    value = F.col(column)
    bad = F.exists(
        value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vectors.filter(
        value.isNotNull() & (F.size(value) > 0) & ~bad & F.exists(value, lambda x: x != 0)
    )


def _keys(rows: np.ndarray, seed: list[int]) -> np.ndarray:
    """On which side of each of ``KEY_BITS`` random hyperplanes the rows lie."""
    planes = np.random.default_rng(seed).standard_normal((rows.shape[1], KEY_BITS), dtype=np.float32)
    side = rows @ planes > 0
    key = np.zeros(len(rows), np.int64)
    for bit in range(KEY_BITS):
        key = (key << 1) | side[:, bit]
    return key


def _pass_rows(n_passes: int):
    """Rows (ordering, key, rep, vector): every vector in each of the passes, by length of vector and pass."""

    def run(batches):
        for batch in batches:
            rows, _ = unit_rows(batch.column(1))
            size = batch.column(2).to_numpy()
            for width in np.unique(size).tolist():
                at = np.flatnonzero(size == width)
                some = rows[at, :width].astype(np.float32)
                picked = pa.array(at)
                rep, vector = batch.column(0).take(picked), batch.column(1).take(picked)
                for number in range(n_passes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), width << 32 | number)),
                            pa.array(_keys(some, [SEED, width, number])),
                            rep,
                            vector,
                        ],
                        names=["ordering", "key", "rep", "vector"],
                    )

    return run


def n_passes(rows: int, task_rows: int, window: int, agree: float, miss: float) -> int:
    """Passes after which a pair that agrees in each bit with probability ``agree`` is missed with odds of ``miss``.

    The two meet in a task if they agree in the bits that part all rows into tasks, and some more where they lie near
    its border, and then in a window of one ordering at least.
    """
    apart = np.log2(rows / task_rows) + 2 if rows > task_rows else 0.0
    inside = max(1.0, np.log2((max(1, min(rows, task_rows)) << SPARE_BITS) / window))
    met = agree**apart * (1 - (1 - agree**inside) ** ORDERINGS)
    return int(np.ceil(SPARE_PASSES * np.log(miss) / np.log1p(-min(met, 1 - 1e-9))))


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits in which keys agree."""
    rest, length = a ^ b, np.zeros(len(a), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        high = (rest >> step) > 0
        length += high * step
        rest = np.where(high, rest >> step, rest)
    return KEY_BITS - length - (rest > 0)


def _parts(batches, whole: bool):
    """(table, before, after) of every pass in a sorted partition, and whether it may go on outside on that side.

    Where another pass begins or ends in the same partition, this one does not, nor where passes are ``whole``.
    """
    last = None
    for table in batches_by(batches, "ordering"):
        if last is not None:
            yield last[0], last[1], False
        last = table, last is None and not whole
    if last is not None:
        yield last[0], last[1], not whole


def _neighbours(rows: np.ndarray, key: np.ndarray, window: int, threshold: float):
    """Pairs of rows in each other's window by the order of ``key``, and per row the bits shared with the windows' ends.

    -1 stands for an ordering that ends within the window.
    """
    order = np.argsort(key, kind="stable")
    rows, key = rows[order], key[order]
    low = rows.astype(np.float32)
    found = []
    for at in range(0, len(rows), TILE):
        end = min(at + TILE + window, len(rows))
        # Single precision is off by far less than this; what is near the threshold is looked at again.
        a, b = np.nonzero(low[at : at + TILE] @ low[at:end].T >= threshold - 1e-4)
        near = (b > a) & (b <= a + window)
        a, b = at + a[near], at + b[near]
        sure = np.einsum("ij,ij->i", rows[a], rows[b]) >= threshold
        found.append((order[a[sure]], order[b[sure]]))
    bits = np.full(len(rows), -1, np.int64)
    if len(rows) > window:
        across = _shared_bits(key[:-window], key[window:])
        bits[:-window] = across
        bits[window:] = np.maximum(bits[window:], across)
    shared = np.empty_like(bits)
    shared[order] = bits
    return found, shared


def _window_links(threshold: float, window: int, agree: float, whole: bool):
    """Links (src, dst, null), and for every row of a pass (rep, null, bound).

    ``bound`` is the logarithm of the odds that the pass misses a neighbour at the threshold: one
    that shares a bit more with the row than the borders of its task do is in the task, and one that shares a bit more
    than the ends of the row's window in an ordering lies in that window.
    """

    def odds(bits: np.ndarray) -> np.ndarray:
        return np.where(bits < KEY_BITS, agree ** (bits + 1.0), 0.0)

    def run(batches):
        links = Links()
        for part, before, after in _parts(batches, whole):
            rows, _ = unit_rows(part.column("vector"))
            low = rows.astype(np.float32)
            rep, key = part.column("rep").to_numpy(), part.column("key").to_numpy()
            ordering = part.column("ordering")[0].as_py()
            border = np.full(len(rep), -1, np.int64)
            for outside, edge in ((before, 0), (after, -1)):
                if outside:
                    border = np.maximum(border, _shared_bits(key, np.full_like(key, key[edge])))
            missed = np.zeros(len(rep))
            for number in range(ORDERINGS):
                fresh = _keys(low, [SEED, ordering >> 32, ordering & 0xFFFFFFFF, number + 1])
                found, bits = _neighbours(rows, fresh, window, threshold)
                for a, b in found:
                    links.add(rep[a], rep[b])
                missed += np.log1p(-np.minimum(odds(bits), 1 - 1e-12))
            met = odds(border) * -np.expm1(missed)
            bound = np.log1p(-np.minimum(met, 1 - 1e-12))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep), pa.nulls(len(rep), pa.int64()), pa.array(bound)], names=["src", "dst", "bound"]
            )
        for batch in links.batches():
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.nulls(batch.num_rows, pa.float64())], names=["src", "dst", "bound"]
            )

    return run


def _block_links(threshold: float):
    """Links (src, dst) between the vectors of two blocks of one size."""

    def run(batches):
        links = Links()
        for left, right, _ in _block_rows(batches):
            (a, _), (b, _) = unit_rows(left.field("vector")), unit_rows(right.field("vector"))
            reps, others = left.field("rep").to_numpy(), right.field("rep").to_numpy()
            for at in range(0, len(a), TILE):
                x, y = np.nonzero(a[at : at + TILE] @ b.T >= threshold)
                links.add(reps[at + x], others[y])
        yield from links.batches()

    return run


def _block_rows(batches):
    """(left, right, same) of every pair of blocks; a block is its own partner if there is no other."""
    for batch in batches:
        for i in range(batch.num_rows):
            left, right = batch.column("left")[i], batch.column("right")[i]
            same = not right.is_valid
            yield left.values, left.values if same else right.values, same


def _block_counts(threshold: float):
    """(rep, n) of the vectors of two blocks of a component that are linked."""

    def run(batches):
        for left, right, same in _block_rows(batches):
            a, _ = unit_rows(left.field("vector"))
            b, _ = unit_rows(right.field("vector"))
            size_a, size_b = (np.diff(x.field("vector").offsets.to_numpy()) for x in (left, right))
            width = min(a.shape[1], b.shape[1])
            n_a, n_b = left.field("copies").to_numpy(), right.field("copies").to_numpy()
            mine, theirs = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for at in range(0, len(a), TILE):
                tile = slice(at, at + TILE)
                linked = (a[tile, :width] @ b[:, :width].T >= threshold) & (size_a[tile, None] == size_b[None, :])
                mine[tile] = linked @ n_b
                if not same:
                    theirs += n_a[tile] @ linked
            reps, counts = left.field("rep").to_numpy(), mine
            if not same:
                reps = np.concatenate([reps, right.field("rep").to_numpy()])
                counts = np.concatenate([counts, theirs])
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(counts)], names=["rep", "n"])

    return run


def _block_pairs(placed: DataFrame, label: str) -> DataFrame:
    """Rows (left, right): all pairs of blocks of each component of ``placed``; right is null for a block itself.

    A pair is a key of its own on both sides of the join, so no task gets more than its two blocks.
    """
    sizes = placed.groupBy("component").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"))
    held = F.least(F.lit(BLOCK), F.greatest(F.lit(TILE), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("width")))))
    blocks = F.ceil(F.col("n") / F.least(F.lit(BLOCK), held)).cast("int")
    dealt = placed.join(
        sizes.filter("n > 1").select("component", blocks.alias("blocks")), "component"
    ).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # One key for component and block: the blocks of a large component go to different tasks.
    packed = stored(
        dealt.groupBy(F.xxhash64("component", "block").alias("cell"), "block").agg(
            F.first("component").alias("component"),
            F.first("blocks").alias("blocks"),
            F.collect_list(F.struct("rep", "copies", "vector")).alias("rows"),
        ),
        label,
    )
    alone = packed.select(F.col("rows").alias("left"), F.lit(None).cast(packed.schema["rows"].dataType).alias("right"))
    several = packed.filter("blocks > 1")
    lower = several.filter("block < blocks - 1").select(
        "component", F.col("block").alias("low"), F.explode(F.expr("sequence(block + 1, blocks - 1)")).alias("high"),
        F.col("rows").alias("left"),
    )
    upper = several.filter("block > 0").select(
        "component", F.explode(F.expr("sequence(0, block - 1)")).alias("low"), F.col("block").alias("high"),
        F.col("rows").alias("right"),
    )
    return alone.unionByName(lower.join(upper, ["component", "low", "high"]).select("left", "right"))


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors`` (vec_id, embedding).

    Two vectors of one length are linked if their cosine is at least ``threshold``. Equal
    vectors are compared once and count as often as they occur. The passes find the components;
    within each, all pairs of blocks are then counted, so n_links misses no member of
    the component. A pair of which either is not crowded is missed with odds of ``miss`` at most,
    however dense other vectors are; pairs of crowded vectors are all compared. Vectors that are null, empty, zero or hold a null or non-finite
    component have no links and are kept. A null vec_id has neither component nor mark, and is
    linked with nothing; rows that repeat a vec_id belong together. Extra columns are not read.
    """
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"))
    known = given.filter("vec_id is not null")
    good = usable(known, "vector")
    groups = stored(
        good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors"
    )
    # An id may be the smallest of several vectors if its rows differ.
    groups = groups.withColumn("size", F.size("vector"))
    n_rows, width = groups.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(1))).first()
    # A component takes twelve bytes, in double and in single precision.
    task_rows = int(min(TASK_ROWS, max(1024, TASK_BYTES // (12 * width))))
    similar = 1 - np.arccos(min(1.0, threshold)) / np.pi
    n_made = n_passes(n_rows, task_rows, window, similar, miss)
    rows = groups.select("rep", "vector", "size").mapInArrow(
        _pass_rows(n_made),
        f"ordering long, key long, rep long, vector {groups.schema['vector'].dataType.simpleString()}",
    )
    # As many tasks as reckoned with: more of them would bring fewer near vectors together. A pass that fits
    # in a task stays whole.
    order, whole = ["ordering", "key", "rep"], n_rows <= task_rows
    if whole:
        dealt = rows.repartition(n_made, "ordering")
    else:
        dealt = rows.repartitionByRange(-(-n_rows * n_made // task_rows), *order)
    ordered = dealt.sortWithinPartitions(*order)
    # Equal vectors have equal marks of 128 bits, which spares sending them once more.
    marks = [F.xxhash64(F.lit(seed), "vector").alias(f"mark{seed}") for seed in (1, 2)]
    members = good.select("vec_id", *marks).join(groups.select("rep", "copies", *marks), ["mark1", "mark2"])
    members = stored(members.select("vec_id", "rep", "copies"), "members")
    ties = members.filter("vec_id <> rep").select(F.col("vec_id").alias("src"), F.col("rep").alias("dst"))
    seen = stored(
        ordered.mapInArrow(_window_links(threshold, window, similar, whole), "src long, dst long, bound double"), "links"
    )
    edges = seen.filter("dst is not null").select("src", "dst")
    bounds = seen.filter("dst is null").groupBy(F.col("src").alias("rep")).agg(F.sum("bound").alias("bound"))
    crowded = groups.join(bounds.filter(F.col("bound") > float(np.log(miss))), "rep")
    crowd = crowded.select(F.col("size").cast("long").alias("component"), "rep", "copies", "vector")
    crowd_pairs = _block_pairs(crowd, "crowd")
    edges = edges.unionByName(crowd_pairs.mapInArrow(_block_links(threshold), "src long, dst long"))
    found = stored(components(edges.unionByName(ties), "embeddings"), "components")

    # Exact counts inside components, over pairs of bounded blocks.
    placed = groups.join(found, F.col("rep") == F.col("node")).select("component", "rep", "copies", "vector")
    pairs = _block_pairs(placed, "blocks")
    counts = pairs.mapInArrow(_block_counts(threshold), "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))
    per_rep = stored(counts, "counts")

    linked = (
        members.join(per_rep, "rep", "left")
        .groupBy("vec_id")
        # Itself is among the members of its group, or among the block's own pairs.
        .agg((F.sum(F.coalesce("n", "copies")) - F.count("*")).alias("n_links"))
        .join(found.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    )
    result = (
        known.select("vec_id")
        .join(linked, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
    lost = given.filter("vec_id is null").select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("component_id"),
        F.lit(None).cast("boolean").alias("kept"),
    )
    return result.unionByName(lost)
