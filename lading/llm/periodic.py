"""Periodic runs in the word sequence of every text, found from Lyndon roots.

A run is a stretch of words with smallest period q that no neighbouring word extends. Phase one of
Baier's suffix sorter puts two places of a sequence into one group exactly if the longest Lyndon words
that start there are equal, and knows their length. Done under an order of the words and under its
reverse, it has in one of both a Lyndon root of every run: the root starts in the run, is as long as
the period, and repeats at that distance. So equal groups one root apart are extended in both
directions by longest common extensions, which gives the run.

A run of at least three periods holds each of its word n-grams (up to a third of its length) twice.
Stretches without a repeated n-gram can hold no run and are not sorted; this is exact.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shortest run in words, and in periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3

# Bytes of collapsed texts that a task hands over at a time.
BATCH_BYTES = 8 << 20

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"

# What the Python function of a task may do to the words of a document before runs are sought.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def lyndon_groups(symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(group, length) for every place: phase one of Baier's suffix sorter.

    ``symbols`` are 0 to m - 1, all of them used. Places whose longest Lyndon words are equal share a group;
    length is that of the word. Groups are visited from the highest to the lowest. The nearest place
    to the left of each member that is still in a lower group is its predecessor; a
    predecessor's word grows by the group's word once per member that points to it, and predecessors
    leave their group for a new one right above it, the ones with more pointers higher.
    """
    n, m = len(symbols), max(symbols, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(m)]
    for place, symbol in enumerate(symbols):
        members[symbol].append(place)
    group = list(symbols)
    size = [1] * m
    above, below = list(range(1, m + 1)), list(range(-1, m - 1))
    # Places that are still in lower groups are linked; the last entry of ``right`` stands for none.
    left, right = list(range(-1, n)), list(range(1, n + 2))
    current = m - 1
    while current >= 0:
        length = size[current]
        pointed: list[int] = []
        pointers: list[int] = []
        last = -1
        # Members come in ascending order, so predecessors do too.
        for place in members[current]:
            if group[place] != current:
                continue
            before, after = left[place], right[place]
            right[before] = after
            left[after] = before
            if before < 0:
                continue
            if before == last:
                pointers[-1] += 1
            else:
                pointed.append(before)
                pointers.append(1)
                last = before
        moved: dict[tuple[int, int], list[int]] = {}
        for place, count in zip(pointed, pointers, strict=True):
            moved.setdefault((-count, group[place]), []).append(place)
        for count, old in sorted(moved) if len(moved) > 1 else moved:
            places, new = moved[count, old], len(size)
            size.append(size[old] - count * length)
            members.append(places)
            for place in places:
                group[place] = new
            upper = above[old]
            above.append(upper)
            below.append(old)
            below[upper] = above[old] = new
        current = below[current]
    groups = np.array(group, np.int64)
    return groups, np.array(size, np.int64)[groups]


def extension(ids: np.ndarray, i: int, j: int) -> int:
    """How many symbols from ``i`` on equal those from ``j`` on, ``i`` < ``j``."""
    length, step = 0, 64
    while j + length < len(ids):
        b = ids[j + length : j + length + step]
        a = ids[i + length : i + length + len(b)]
        same = a == b
        if not same.all():
            return length + int(same.argmin())
        length, step = length + len(b), min(2 * step, 1 << 16)
    return length


def maximal_runs(ids: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``least`` symbols and ``periods`` periods."""
    n = len(ids)
    _, dense = np.unique(ids, return_inverse=True)
    backwards = dense[::-1]
    places = np.arange(n)
    found = set()
    for symbols in (dense, dense.max(initial=0) - dense):
        group, length = lyndon_groups(symbols.tolist())
        # All roots of a run but one period at its edges are whole and follow each other.
        roots = (np.maximum(least, periods * length) - length + 1) // length
        far = places + (roots - 1) * length
        again = np.flatnonzero(far < n)
        again = again[(group[far[again]] == group[again]) & (group[again + length[again]] == group[again])]
        before = again - length[again]
        first = again[(before < 0) | (group[before] != group[again])]
        for i in first.tolist():
            period = int(length[i])
            start = i - extension(backwards, n - i - period, n - i)
            stop = i + period + extension(dense, i, i + period)
            if stop - start >= max(least, periods * period):
                found.add((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeated_stretches(ids: np.ndarray, least: int, gram_bits: int) -> list[tuple[int, int]]:
    """Stretches (start, stop) of at least ``least`` symbols covered by n-grams that occur twice.

    n is two to the power ``gram_bits``. Hashes stand for n-grams: equal ones can only add a stretch.
    """
    grams, width = ids.astype(np.uint64), 1
    with np.errstate(over="ignore"):
        for _ in range(gram_bits):
            if len(grams) <= width:
                return []
            grams = grams[:-width] * np.uint64(0x9E3779B97F4A7C15) + (grams[width:] ^ np.uint64(width))
            grams ^= grams >> np.uint64(29)
            width *= 2
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, grams)
    hit = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == grams)
    cuts = np.flatnonzero(np.diff(hit) > width)
    starts = hit[np.concatenate([[0], cuts + 1])]
    stops = hit[np.concatenate([cuts, [len(hit) - 1]])] + width
    return [(a, b) for a, b in zip(starts.tolist(), stops.tolist(), strict=True) if b - a >= least]


def word_runs(words: list[bytes], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a word sequence, by start, then period."""
    if periods < 3:
        raise ValueError("two whole roots in a row, by which runs are found, take three periods")
    if len(words) < least:
        return []
    index = dict.fromkeys(words)
    for number, word in enumerate(index):
        index[word] = number
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    gram_bits = (least * (periods - 2) // periods + 1).bit_length() - 1
    runs = []
    for start, stop in repeated_stretches(ids, least, gram_bits):
        runs += [(start + a, n, q) for a, n, q in maximal_runs(ids[start:stop], least, periods)]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what repeats in a run: of each only the first period stays."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _batch(ids: list, counts: list[int], runs: list, texts: list[bytes]) -> pa.RecordBatch:
    flat = np.array([r for some in runs for r in some], np.int64).reshape(-1, 3)
    offsets = np.concatenate([[0], np.cumsum([len(some) for some in runs], dtype=np.int64)]).astype(np.int32)
    fields = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
    spans = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), spans),
            pa.array(texts, pa.binary()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    periods: int = LEAST_PERIODS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed), one per row of ``docs``.

    Words are what ASCII white space parts, numbered from 0. ``runs`` holds (start, length, period) of every run of
    at least ``least`` words and ``periods`` periods, by start, then period. ``collapsed`` is the text
    with one space between words and, of every run, the first period only. ``prepare``
    may change the words of a document first.

    Every text is worked on by itself and whole, in the task that reads it; nothing is shuffled.
    Null and blank texts have no word and no run, their collapsed text is empty. Repeated rows and
    rows without doc_id are rows like any other. Columns but doc_id and text are not read.
    """

    def run(batches):
        ids, counts, runs, texts, size = [], [], [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                if prepare is not None:
                    words = prepare(key.as_py(), words)
                some = word_runs(words, least, periods)
                ids.append(key.as_py())
                counts.append(len(words))
                runs.append(some)
                texts.append(b" ".join(collapsed(words, some)))
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    yield _batch(ids, counts, runs, texts)
                    ids, counts, runs, texts, size = [], [], [], [], 0
        if ids:
            yield _batch(ids, counts, runs, texts)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, SCHEMA).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs):
    """Of a column of runs the one with the greatest length over period; the first among equals."""
    better = lambda best, run: best.isNull() | (
        run["length"] * best["period"] > best["length"] * run["period"]
    )
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, run: F.when(better(best, run), run).otherwise(best))
