"""How far the vocabularies of sources lie apart, from an index that is built in one pass.

Tasks collect the terms of their documents in memory until a block is full, and hand the block over as a
run: postings sorted by term, cut into segments by a hash of the term. The runs of a segment are merged by
a heap, about ``fan_in`` at a time, into the frequencies of every term. The distance of two sources is
that of sources without any term, which needs no term, plus corrections: those of terms that one
source has follow from how many of its terms occur how often; those of terms that both have are
streamed over the frequencies.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.llm.common import batches_by, discarded, numbered, stored

# Fixed value: the scale of probabilities.
SCALE = 1_000_000_000


@dataclass(frozen=True)
class Limits:
    """How much tasks hold at a time; the result does not depend on it.

    A block is full with ``block_terms`` different terms or ``block_entries`` terms of documents. About ``fan_in`` runs
    are merged at once, ``piece`` postings of each looked at together. Segments of runs are made by ``segment_bits``
    of a term's hash, or more where one would hold more than ``segment_entries``. ``pairs`` are worked out together.
    """

    block_terms: int = 500_000
    block_entries: int = 2_000_000
    fan_in: int = 64
    piece: int = 4096
    segment_bits: int = 8
    segment_entries: int = 400_000
    pairs: int = 1 << 20


# All bytes that are in no term become spaces, A-Z become a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

RUN = "run long, segment long, n long, postings binary"
FREQUENCY = "term_no long, lang string, term string, source string, count long, total long, first boolean"
CORRECTION = "gid long, other long, value long"

_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased."""
    return (text or b"").translate(_FOLD).split()


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _ranked(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Sorted distinct values, by bytes, and for every distinct value its place among them."""
    order = pc.sort_indices(values).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values.take(pa.array(order)), rank


class Postings:
    """How often sources have terms, and in how many documents, in the order of lang, term and source.

    ``key`` numbers (lang, term, source) in that order; langs, terms and sources are sorted.
    """

    def __init__(self, langs, terms_, sources, key: np.ndarray, count: np.ndarray, docs: np.ndarray) -> None:
        self.langs, self.terms, self.sources = langs, terms_, sources
        self.key, self.count, self.docs = key, count, docs

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the lang, term and source of every posting are in their lists."""
        of_term, source = np.divmod(self.key, max(1, len(self.sources)))
        return *np.divmod(of_term, max(1, len(self.terms))), source

    def segments(self, bits: int):
        """(segment, rows, bytes) by the hash of lang and term."""
        lang, term, source = self.places()
        of_term = lang * max(1, len(self.terms)) + term
        starts = np.flatnonzero(np.diff(of_term, prepend=-1))
        seeds, words = [crc32(value) for value in self.langs.to_pylist()], self.terms.to_pylist()
        hashes = [crc32(words[t], seeds[x]) for x, t in zip(lang[starts].tolist(), term[starts].tolist(), strict=True)]
        segment = np.repeat(np.array(hashes, np.int64) >> (32 - bits), np.diff(np.append(starts, len(self.key))))
        order = np.argsort(segment, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(segment[order], prepend=-1)), len(order))
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = order[start:stop]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.DictionaryArray.from_arrays(pa.array(lang[at], pa.int32()), self.langs),
                    self.terms.take(pa.array(term[at])),
                    pa.DictionaryArray.from_arrays(pa.array(source[at], pa.int32()), self.sources),
                    pa.array(self.count[at]),
                    pa.array(self.docs[at]),
                ],
                names=["lang", "term", "source", "count", "docs"],
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=_ZSTD) as writer:
                writer.write_batch(batch)
            yield int(segment[at[0]]), len(at), sink.getvalue().to_pybytes()


def _run_batch(postings: Postings, run: int, bits: int) -> pa.RecordBatch:
    found = list(postings.segments(bits))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(found), run, np.int64)),
            pa.array([segment for segment, _, _ in found], pa.int64()),
            pa.array([n for _, n, _ in found], pa.int64()),
            pa.array([data for _, _, data in found], pa.binary()),
        ],
        names=["run", "segment", "n", "postings"],
    )


class _Block:
    """Documents' terms in memory."""

    def __init__(self) -> None:
        self.numbers, self.groups = _Numbers(), _Numbers()
        self.term, self.count, self.group = [], [], []
        self.entries = 0

    def add(self, lang: bytes, source: bytes, found: list[bytes]) -> None:
        numbers = np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))
        term, count = np.unique(numbers, return_counts=True)
        self.term.append(term)
        self.count.append(count)
        self.group.append(np.full(len(term), self.groups[lang, source], np.int32))
        self.entries += len(term)

    def postings(self) -> Postings:
        """The block's terms, each document counted once, put in order."""
        langs = pa.array(sorted({lang for lang, _ in self.groups}), pa.binary())
        sources = pa.array(sorted({source for _, source in self.groups}), pa.binary())
        places = ({v: i for i, v in enumerate(values.to_pylist())} for values in (langs, sources))
        lang_at, source_at = places
        lang = np.array([lang_at[x] for x, _ in self.groups], np.int64)
        source = np.array([source_at[x] for _, x in self.groups], np.int64)
        words, rank = _ranked(pa.array(list(self.numbers), pa.binary()))
        group = np.concatenate(self.group)
        key = (lang[group] * len(words) + rank[np.concatenate(self.term)]) * len(sources) + source[group]
        order = np.argsort(key, kind="stable")
        key, count = key[order], np.concatenate(self.count)[order].astype(np.int64)
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        docs = np.diff(np.append(cuts, len(key)))
        return Postings(langs, words, sources, key[cuts], np.add.reduceat(count, cuts), docs)


def _index(limits: Limits):
    """A task's documents as runs."""

    def run(batches):
        block, number = _Block(), 0

        def spilled():
            return _run_batch(block.postings(), TaskContext.get().partitionId() << 32 | number, limits.segment_bits)

        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                found = terms(text.as_py())
                if found:
                    block.add(lang.as_py(), source.as_py(), found)
                if block.entries >= limits.block_entries or len(block.numbers) >= limits.block_terms:
                    yield spilled()
                    block, number = _Block(), number + 1
        if block.entries:
            yield spilled()

    return run


def heap_merged(runs: list[tuple[np.ndarray, ...]], piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, count, docs) of runs of such, each in the order of its different keys, equal keys added.

    The heap holds the last key of the piece of each run that is looked at. Up to the smallest of these all
    runs are known, so that much is merged; whoever's piece is used up then shows its next one.
    """
    at = [0] * len(runs)
    heap = [(int(keys[min(piece, len(keys)) - 1]), i) for i, (keys, _, _) in enumerate(runs) if len(keys)]
    heapq.heapify(heap)
    merged = []
    while heap:
        bound, taken = heap[0][0], []
        for _, i in heap:
            start = at[i]
            at[i] += int(np.searchsorted(runs[i][0][start : start + piece], bound, "right"))
            if at[i] > start:
                taken.append([column[start : at[i]] for column in runs[i]])
        while heap and heap[0][0] == bound:
            _, i = heapq.heappop(heap)
            keys = runs[i][0]
            if at[i] < len(keys):
                heapq.heappush(heap, (int(keys[min(at[i] + piece, len(keys)) - 1]), i))
        key, count, docs = (np.concatenate(columns) for columns in zip(*taken, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        merged.append((key[cuts], np.add.reduceat(count[order], cuts), np.add.reduceat(docs[order], cuts)))
    if not merged:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(columns) for columns in zip(*merged, strict=True))


def _merged(unit: pa.Table, limits: Limits) -> Postings:
    """The postings of the runs of one unit."""
    tables = [pa.ipc.open_stream(data.as_buffer()).read_all() for data in unit.column("postings")]
    # One run may have several rows if its segments were finer before: these stay runs of their own.
    lengths = [table.num_rows for table in tables]
    lists, places = [], []
    for name in ("lang", "term", "source"):
        chunks = [chunk.dictionary_decode() if name != "term" else chunk for t in tables for chunk in t.column(name).chunks]
        coded = pa.chunked_array(chunks, pa.binary()).combine_chunks().dictionary_encode()
        values, rank = _ranked(coded.dictionary)
        lists.append(values)
        places.append(rank[coded.indices.to_numpy()])
    lang, term, source = places
    key = (lang * len(lists[1]) + term) * len(lists[2]) + source
    count, docs = (np.concatenate([t.column(name).to_numpy() for t in tables]) for name in ("count", "docs"))
    ends = np.cumsum(lengths)
    runs = [(key[e - n : e], count[e - n : e], docs[e - n : e]) for e, n in zip(ends, lengths, strict=True)]
    return Postings(*lists, *heap_merged(runs, limits.piece))


def _merge_runs(bits: int, limits: Limits):
    """Each unit of runs becomes one run, named by its group."""

    def run(batches):
        for unit in batches_by(batches, "unit"):
            yield _run_batch(_merged(unit, limits), unit.column("group")[0].as_py(), bits)

    return run


def _frequencies(least_docs: int, limits: Limits):
    """Frequencies of the terms that are in at least ``least_docs`` documents of their language."""

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for unit in batches_by(batches, "unit"):
            found = _merged(unit, limits)
            lang, term, source = found.places()
            # The sources of a term come one after the other.
            starts = np.flatnonzero(np.diff(lang * len(found.terms) + term, prepend=-1))
            sizes = np.diff(np.append(starts, len(term)))
            kept = np.add.reduceat(found.docs, starts) >= least_docs
            total = np.repeat(np.add.reduceat(found.count, starts), sizes)
            first = np.zeros(len(term), bool)
            first[starts] = True
            at = np.flatnonzero(np.repeat(kept, sizes))
            numbers = number + np.cumsum(first[at]) - 1
            number += int(kept.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers),
                    *(
                        values.take(pa.array(places[at])).cast(pa.string())
                        for values, places in ((found.langs, lang), (found.terms, term), (found.sources, source))
                    ),
                    pa.array(found.count[at]),
                    pa.array(total[at]),
                    pa.array(first[at]),
                ],
                names=["term_no", "lang", "term", "source", "count", "total", "first"],
            )

    return run


def frequencies(docs: DataFrame, least_docs: int = 3, limits: Limits = Limits()) -> DataFrame:
    """Rows (term_no, lang, term, source, count, total, first) of the kept terms.

    ``docs`` has lang, source and text. ``count`` is how often the source has the term, ``total`` how often the
    language has it; ``first`` marks one row per term and ``term_no`` numbers terms, with gaps. A frequent term is
    one posting per run and source at most, and runs are merged about ``fan_in`` at a time, so that no task holds more.
    """
    narrow = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source")),
        F.col("text").cast("binary"),
    )
    runs = stored(narrow.mapInArrow(_index(limits), RUN), "runs")

    def units(group: Column, n_groups: int) -> DataFrame:
        """Whole units in one task each, a unit's runs one after the other."""
        return (
            runs.withColumns({"group": group, "unit": F.col("segment") * n_groups + group})
            .select("unit", "group", "run", "postings")
            .repartition(max(1, -(-(rows or 0) // limits.segment_entries)), "unit")
            .sortWithinPartitions("unit", "run")
        )

    bits = limits.segment_bits
    while True:
        rows, n_runs = runs.agg(F.sum("n"), F.count_distinct("run")).first()
        n_groups = -(-n_runs // limits.fan_in)
        if n_groups <= 1:
            break
        # A segment is only ever divided, so that all of a term stays in one.
        bits = min(31, max(bits, (-(-rows // limits.segment_entries) - 1).bit_length()))
        group = F.pmod(F.xxhash64("run"), F.lit(n_groups))
        merged = stored(units(group, n_groups).mapInArrow(_merge_runs(bits, limits), RUN), "merged")
        discarded(runs)
        runs = merged
    whole = units(F.lit(0).cast("long"), 1).mapInArrow(_frequencies(least_docs, limits), FREQUENCY)
    found = stored(whole, "frequencies")
    discarded(runs)
    return found


def scaled(count: Column, size: Column) -> Column:
    """1 + floor(SCALE x (count + 1) / size), exactly; null without terms."""
    above = (count.cast("decimal(19,0)") + 1) * F.lit(SCALE)
    return F.when(size > 0, 1 + F.call_function("div", above, size.cast("decimal(19,0)"))).cast("long")


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), exactly: both are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_sums(gid: np.ndarray, p: np.ndarray, p0: np.ndarray, first: np.ndarray, pairs: int):
    """(gid, other, value) for the pairs of rows of the same term, summed; ``first`` are the places where terms begin.

    About ``pairs`` of them are held at a time.
    """
    sizes = np.diff(np.append(first, len(gid)))
    begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    ends = np.cumsum(size)
    names, place = np.unique(gid, return_inverse=True)
    at = done = 0
    while at < len(gid):
        stop = max(at + 1, int(np.searchsorted(ends, done + pairs, "right")))
        a = np.repeat(np.arange(at, stop), size[at:stop])
        # The n-th partner of a row is the n-th row of its term.
        b = begin[a] + np.arange(done, ends[stop - 1]) - (ends[a] - size[a])
        at, done = stop, int(ends[stop - 1])
        a, b = a[a != b], b[a != b]
        value = _apart(p[a], p[b]) - _apart(p[a], p0[b]) - _apart(p0[a], p[b]) + _apart(p0[a], p0[b])
        both = place[a] * len(names) + place[b]
        if len(names) ** 2 <= pairs:
            added = np.zeros(len(names) ** 2, np.int64)
            np.add.at(added, both, value)
            met = np.flatnonzero(np.bincount(both, minlength=len(added)))
            added = added[met]
        else:
            order = np.argsort(both, kind="stable")
            cuts = np.flatnonzero(np.diff(both[order], prepend=-1))
            met, added = both[order][cuts], np.add.reduceat(value[order], cuts) if len(cuts) else value
        x, y = np.divmod(met, len(names))
        yield names[x], names[y], added


def _pair_corrections(limits: Limits):
    """Sums over terms of what the distance of two sources that both have the term differs by.

    Rows come sorted by term, the first of each marked; a term's rows meet each other, at most one per source.
    """

    def run(batches):
        sums: dict[tuple[int, int], int] = {}

        def flushed():
            gid, other = zip(*sums, strict=True)
            made = [pa.array(column, pa.int64()) for column in (gid, other, sums.values())]
            sums.clear()
            return pa.RecordBatch.from_arrays(made, names=["gid", "other", "value"])

        def add(table: pa.Table, first: np.ndarray):
            for x, y, values in _pair_sums(*(table.column(c).to_numpy() for c in ("gid", "p", "p0")), first, limits.pairs):
                for i, j, value in zip(x.tolist(), y.tolist(), values.tolist(), strict=True):
                    sums[i, j] = sums.get((i, j), 0) + value
                if len(sums) > limits.pairs:
                    yield flushed()

        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
            first = np.flatnonzero(held.column("first").to_numpy(zero_copy_only=False)) if held.num_rows else ()
            # The last term may go on in the next batch.
            if len(first) > 1:
                yield from add(held.slice(0, int(first[-1])), first[:-1])
                held = held.slice(int(first[-1]))
        if held is not None and held.num_rows:
            yield from add(held, np.zeros(1, np.int64))
        if sums:
            yield flushed()

    return run


def audit(docs: DataFrame, least_docs: int = 3, most_terms: int = 200, limits: Limits = Limits()) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how sources of a language differ.

    Part ``pair`` has every other source of the language with the sum, over all kept terms, of
    floor((p - q)^2 / q), where p and q are the scaled probabilities of the term in the source and in the other.
    Part ``term`` has the terms that the source has more often than its language, up to rank ``most_terms``.
    Ranks are by falling value, then by item in UTF-8 order. A term is kept in a language
    if ``least_docs`` of its documents have it. Every row of ``docs`` is a document. Null lang, source and text
    count as empty; a source without terms is a source too, a language without kept terms
    has distances of 0. Other columns are not read.
    """
    known = frequencies(docs, least_docs, limits)
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    pairs_of = docs.select(*empty).distinct()
    sizes = known.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = known.groupBy("lang").agg(
        F.sum("count").alias("n_lang"), F.sum(F.col("first").cast("long")).alias("v")
    )
    zero = F.lit(0).cast("long")
    named = numbered(stored(pairs_of, "groups"), ["lang", "source"], "groups", "gid")
    groups = (
        named.join(sizes, ["lang", "source"], "left")
        .join(langs, ["lang"], "left")
        .select(
            "gid", "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n", "n_lang", "v"))
        )
        .withColumn("p0", scaled(zero, F.col("n") + F.col("v")))
    )
    groups = stored(groups, "groups")
    rated = known.join(groups, ["lang", "source"]).withColumn(
        "p", scaled(F.col("count"), F.col("n") + F.col("v"))
    )
    rated = stored(
        rated.select("term_no", "lang", "term", "source", "gid", "first", "total", "p", "p0", "n_lang", "v"), "rated"
    )

    telling = (
        rated.withColumn("q", scaled(F.col("total"), F.col("n_lang") + F.col("v")))
        .filter("p > q")
        .select("gid", "lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    )
    place = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item"))
    telling = telling.withColumn("rank", place).filter(F.col("rank") <= most_terms)

    other = groups.select("lang", F.col("gid").alias("other"), F.col("p0").alias("q0"))
    exact = "decimal(38,0)"
    nothing = groups.join(other, "lang").filter("gid <> other").select(
        "gid", "other", F.coalesce(F.col("v").cast("decimal(19,0)") * apart(F.col("p0"), F.col("q0")), F.lit(0)).cast(exact).alias("value")
    )
    # Sources have few different counts: one row stands for all terms that occur equally often.
    alike = rated.groupBy("gid", "lang", "p", "p0").agg(F.count("*").alias("n_terms"))
    met = stored(alike.join(other, "lang").filter("gid <> other"), "alike")
    base = apart(F.col("p0"), F.col("q0"))
    times = F.col("n_terms").cast("decimal(19,0)")
    mine = met.select("gid", "other", (times * (apart(F.col("p"), F.col("q0")) - base)).cast(exact).alias("value"))
    back = apart(F.col("q0"), F.col("p0"))
    theirs = met.select(
        F.col("other").alias("gid"),
        F.col("gid").alias("other"),
        (times * (apart(F.col("q0"), F.col("p")) - back)).cast(exact).alias("value"),
    )
    both = (
        rated.select("term_no", "gid", "first", "p", "p0")
        .repartition("term_no")
        # Ids follow the order of sources, so a term's marked row comes first.
        .sortWithinPartitions("term_no", "gid")
        .select("first", "gid", "p", "p0")
        .mapInArrow(_pair_corrections(limits), CORRECTION)
        .select("gid", "other", F.col("value").cast(exact).alias("value"))
    )
    summed = (
        nothing.unionByName(mine).unionByName(theirs).unionByName(both)
        .groupBy("gid", "other")
        .agg(F.sum("value").cast("long").alias("value"))
    )
    names = groups.select(F.col("gid").alias("other"), F.col("source").alias("item"))
    pairs = (
        summed.join(names, "other")
        .join(groups.select("gid", "lang", "source"), "gid")
        .select("gid", "lang", "source", "item", "value")
        .withColumn("rank", place)
    )
    parts = pairs.withColumn("part", F.lit("pair")).unionByName(telling.withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", "value", "rank")
