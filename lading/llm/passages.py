"""Removing passages that an earlier document has too, with suffix arrays of shards.

Every string of ``length`` bytes has an anchor: of the shorter strings in it the one with
the smallest hash. Equal strings have equal anchors, so only places whose anchor occurs in
several documents are looked at further. Their surroundings, each once per block of documents,
are brought together by anchor into shards of bounded size. A shard's suffixes are sorted by
induced sorting; common prefixes of ``length`` bytes then say which strings are equal, and which
document has each first. Texts never meet in one task; what goes back to a block is which of
its places are covered.

Documents whose whole text an earlier one has are settled by a digest. An anchor that very many
documents share, with ever other surroundings, is split up: each of its strings goes to a
shard of its own hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import batches_by, stored, tasks
from lading.llm.suffix import repeats, suffix_array

LENGTH = 50
ANCHOR = 24

# Bytes of text in a block, of text hashed at a time, of text that leaves a task together, of text
# per bucket of anchors, of a shard.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
PART_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
SHARD_BYTES = 3 << 20

# An anchor of so many documents is split up.
HOT_DOCUMENTS = 20_000

# Documents without id come after all others.
LAST_ID = (1 << 63) - 1

_MULTIPLIER = 0xD6E8FEB86659FD93
_TABLE = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        made = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def places(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int, anchor: int):
    """Where strings of ``length`` bytes start, in runs that share an anchor.

    Arrays (piece, start, count, anchor, surroundings): piece is the one of [starts, stops) that
    the run is in, start its first place in ``data``, count its number of places, anchor the hash of the
    anchor, surroundings a hash of the bytes of all its strings.
    """
    n = len(data)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[:n], out=sums[1:])
    hashes = _mixed((sums[anchor:] - sums[:-anchor]) * inverse[: n + 1 - anchor])
    width, span = length - anchor + 1, 1
    least = hashes
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    sizes = np.maximum(stops - starts - length + 1, 0)
    piece = np.repeat(np.arange(len(starts)), sizes)
    at = np.repeat(starts, sizes) + np.arange(len(piece)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    value = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    # Runs in periodic text may be longer than an anchor reaches; they are cut.
    inside = np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))
    first = np.flatnonzero(inside % width == 0)
    count = np.diff([*first, len(at)])
    begin = at[first]
    end = begin + count - 1 + length
    around = _mixed((sums[end] - sums[begin]) * inverse[begin] + count.astype(np.uint64))
    return piece[first], begin, count, value[first], around


def _pieces(texts: list[bytes], length: int):
    """Groups of (document, offset, bytes) of bounded size; long texts overlap by length - 1."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text)), CHUNK_BYTES):
            part = text[at : at + CHUNK_BYTES + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > CHUNK_BYTES + length and group:
                yield group
                group, size = [], 0
            group.append((number, at, part))
            size += len(part)
    if group:
        yield group


def _runs(texts: list[bytes], length: int, anchor: int):
    """(data, document, offset, begin, count, anchor, surroundings) of groups of texts."""
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
        sizes = np.array([len(part) for _, _, part in group])
        stops = np.cumsum(sizes)
        starts = stops - sizes
        piece, begin, count, value, around = places(data, starts, stops, length, anchor)
        document = np.array([number for number, _, _ in group])[piece]
        offset = np.array([at for _, at, _ in group])[piece] + begin - starts[piece]
        yield data, document, offset, begin, count, value, around


def _pack(columns: dict) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _parts(batches, size: int):
    """Slices of the batches with a bounded number of bytes, a long text by itself."""
    for batch in batches:
        ends = np.cumsum(pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def _rows(rows: list[tuple], **fields: pa.DataType):
    """The rows as one batch, if there are any."""
    if rows:
        arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(fields.values())]
        yield pa.RecordBatch.from_arrays(arrays, names=list(fields))


def _groups(key: np.ndarray):
    """(value, order) of equal keys."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(key[part[0]]), part


def _anchor_rows(length: int, anchor: int, n_blocks: int, n_buckets: int):
    """Rows (bucket, block, values, counts): the anchors of a batch and in how many of its texts."""

    def run(batches):
        for batch in _parts(batches, PART_BYTES):
            block = batch.column(0).to_numpy()
            texts = _bytes(batch.column(1))
            values, documents = [], []
            for _, document, _, _, _, value, _ in _runs(texts, length, anchor):
                order = np.lexsort((document, value))
                value, document = value[order], document[order]
                fresh = np.ones(len(value), bool)
                fresh[1:] = (value[1:] != value[:-1]) | (document[1:] != document[:-1])
                values.append(value[fresh])
                documents.append(document[fresh])
            if not values:
                continue
            value, document = np.concatenate(values), np.concatenate(documents)
            low = (value & np.uint64(0xFFFFFFFF)).astype("<u4")
            bucket = ((value >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
            cell = bucket * n_blocks + block[document]
            order = np.lexsort((low, cell))
            low, cell = low[order], cell[order]
            first = np.ones(len(low), bool)
            first[1:] = (low[1:] != low[:-1]) | (cell[1:] != cell[:-1])
            at = np.flatnonzero(first)
            counts = np.minimum(np.diff([*at, len(low)]), 255).astype("u1")
            low, cell = low[at], cell[at]
            cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            stops = [*cuts[1:].tolist(), len(cell)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((cell[cuts] // n_blocks).astype(np.int32)),
                    pa.array((cell[cuts] % n_blocks).astype(np.int32)),
                    pa.array([low[i:j].tobytes() for i, j in zip(cuts.tolist(), stops, strict=True)], pa.binary()),
                    pa.array([counts[i:j].tobytes() for i, j in zip(cuts.tolist(), stops, strict=True)], pa.binary()),
                ],
                names=["bucket", "block", "values", "counts"],
            )

    return run


def _shared_rows(hot: int):
    """Rows (block, bucket, values, hot): the anchors of a block that occur in several texts."""

    def run(batches):
        for group in batches_by(batches, "bucket"):
            parts = group.column("values").to_pylist()
            sizes = np.array([len(p) // 4 for p in parts])
            value = np.frombuffer(b"".join(parts), "<u4")
            count = np.frombuffer(b"".join(group.column("counts").to_pylist()), "u1").astype(np.int64)
            block = np.repeat(group.column("block").to_numpy(), sizes)
            order = np.argsort(value, kind="stable")
            value, count, block = value[order], count[order], block[order]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            total = np.repeat(np.add.reduceat(count, first), np.diff([*first, len(value)]))
            keep = total > 1
            value, block, very = value[keep], block[keep], total[keep] >= hot
            rows = []
            for number, at in _groups(block):
                mine, places_ = np.unique(value[at], return_index=True)
                marked = very[at][places_].astype("u1").tobytes()
                rows.append((number, group.column("bucket")[0].as_py(), mine.tobytes(), marked))
            yield from _rows(rows, block=pa.int32(), bucket=pa.int32(), values=pa.binary(), hot=pa.binary())

    return run


def _text_rows(batches):
    """Rows (block, texts): the documents of a batch by block, compressed."""
    for batch in _parts(batches, 2 * PART_BYTES):
        table = pa.Table.from_batches([batch])
        rows = []
        for number, at in _groups(batch.column(0).to_numpy()):
            part = table.take(pa.array(at))
            texts = part.column("text").cast(pa.binary()).fill_null(b"")
            columns = [part.column(c).combine_chunks() for c in ("doc_id", "mark")]
            rows.append((number, _pack({"doc_id": columns[0], "mark": columns[1], "text": texts.combine_chunks()})))
        yield from _rows(rows, block=pa.int32(), texts=pa.binary())


def _block_documents(left: pa.Table, right: pa.Table):
    """(ids with LAST_ID for null, texts, whether repeated as a whole) in a fixed order."""
    tables = [_unpack(data) for data in left.column("texts").to_pylist()]
    if not tables:
        return np.zeros(0, np.int64), [], np.zeros(0, bool)
    table = pa.concat_tables(tables)
    ids = table.column("doc_id").fill_null(LAST_ID).to_numpy()
    marks = table.column("mark").to_numpy()
    order = np.lexsort((marks, ids))
    ids, marks = ids[order], marks[order]
    texts = table.column("text").take(pa.array(order)).to_pylist()
    again = {
        (i, m)
        for kind, i, m in zip(*(right.column(c).to_pylist() for c in ("kind", "id", "mark")), strict=True)
        if kind == 1
    }
    whole = np.array([(i, m) in again for i, m in zip(ids.tolist(), marks.tolist(), strict=True)], bool)
    return ids, texts, whole


def _message_rows(length: int, anchor: int, n_buckets: int, n_shards: int):
    """Rows (shard, block, data): surroundings for the shards; with shard -1 the block's own places."""

    def run(left, right):
        ids, texts, whole = _block_documents(left, right)
        texts = [b"" if w else t for t, w in zip(texts, whole.tolist(), strict=True)]
        known, very = [], []
        for kind, bucket, values, hot in zip(
            *(right.column(c).to_pylist() for c in ("kind", "bucket", "values", "hot")), strict=True
        ):
            if kind == 0:
                known.append(np.frombuffer(values, "<u4").astype(np.uint64) | np.uint64(bucket << 32))
                very.append(np.frombuffer(hot, "u1") > 0)
        out: list[tuple[int, int, bytes]] = []
        if known:
            block = right.column("block")[0].as_py()
            known_, very_ = np.concatenate(known), np.concatenate(very)
            order = np.argsort(known_)
            known_, very_ = known_[order], very_[order]
            found = []
            for data, document, offset, begin, count, value, around in _runs(texts, length, anchor):
                key = ((value >> np.uint64(32)) % np.uint64(n_buckets)) << np.uint64(32) | value & np.uint64(0xFFFFFFFF)
                spot = np.minimum(np.searchsorted(known_, key), len(known_) - 1)
                hit = known_[spot] == key
                hot = hit & very_[spot]
                plain = np.flatnonzero(hit & ~hot)
                chosen = (x[plain] for x in (begin, count, document, offset, value, around))
                found.append(_taken(data, length, *chosen))
                if hot.any():
                    # Every string by itself: its own hash takes the place of the anchor.
                    at = np.flatnonzero(hot)
                    step = np.concatenate([np.arange(c) for c in count[at]])
                    one = np.repeat(at, count[at])
                    places_ = begin[one] + step
                    own = _string_hashes(data, places_, length)
                    single = np.ones(len(one), np.int64)
                    found.append(_taken(data, length, places_, single, document[one], offset[one] + step, own, own))
            out = _messages(found, ids, block, n_shards)
        fields = {"shard": pa.int32(), "block": pa.int32(), "data": pa.binary()}
        return pa.table({n: pa.array([row[i] for row in out], t) for i, (n, t) in enumerate(fields.items())})

    return run


def _string_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], out=sums[1:])
    return _mixed((sums[at + length] - sums[at]) * inverse[at])


def _taken(data, length, begin, count, document, offset, value, around):
    """What is known of places, with the bytes of each kind of surroundings once."""
    order = np.lexsort((around, value))
    v, a = value[order], around[order]
    new = np.ones(len(order), bool)
    new[1:] = (v[1:] != v[:-1]) | (a[1:] != a[:-1])
    first, kind = order[new], np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    whole = data.tobytes()
    pieces = [whole[b : b + c - 1 + length] for b, c in zip(begin[first].tolist(), count[first].tolist(), strict=True)]
    return value, around, document, offset, count, kind, pieces


def _messages(found, ids: np.ndarray, block: int, n_shards: int) -> list[tuple[int, int, bytes]]:
    value = np.concatenate([f[0] for f in found])
    around = np.concatenate([f[1] for f in found])
    document = np.concatenate([f[2] for f in found])
    offset = np.concatenate([f[3] for f in found])
    count = np.concatenate([f[4] for f in found])
    if not len(value):
        return []
    shift = np.cumsum([0] + [len(f[6]) for f in found])
    source = np.concatenate([f[5] + s for f, s in zip(found, shift[:-1].tolist(), strict=True)])
    bytes_ = [p for f in found for p in f[6]]
    order = np.lexsort((around, value))
    new = np.ones(len(order), bool)
    v, a = value[order], around[order]
    new[1:] = (v[1:] != v[:-1]) | (a[1:] != a[:-1])
    first = np.flatnonzero(new)
    number = np.empty(len(order), np.int32)
    number[order] = (np.cumsum(new) - 1).astype(np.int32)
    owner = ids[document][order]
    low, high = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    chosen = order[first]
    shard = (_mixed(value[chosen]) % np.uint64(n_shards)).astype(np.int64)
    rows = []
    for number_of, at in _groups(shard):
        rows.append(
            (
                number_of,
                block,
                _pack(
                    {
                        "number": at.astype(np.int32),
                        "anchor": value[chosen[at]],
                        "low": low[at],
                        "high": high[at],
                        "bytes": pa.array([bytes_[i] for i in source[chosen[at]].tolist()], pa.binary()),
                    }
                ),
            )
        )
    own = {"number": number, "document": document.astype(np.int32), "offset": offset}
    rows.append((-1, block, _pack(own)))
    return rows


def first_owners(anchors: np.ndarray, owners: np.ndarray, strings: list[bytes], length: int):
    """(string, start, count, owner) runs: who has each string of ``length`` bytes first.

    Strings with one anchor are compared by the suffix array of all of them; a string that is
    alone with its anchor belongs to its own first owner throughout.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    counts = sizes - length + 1
    order = np.argsort(anchors, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = anchors[order][1:] == anchors[order][:-1]
    several = np.zeros(len(order), bool)
    several[order] = same | np.concatenate([same[1:], [False]])
    owner = np.repeat(owners, counts)
    if several.any():
        chosen = np.flatnonzero(several)
        # 0xFF is in no UTF-8 text, so nothing equal reaches over it.
        joined = np.frombuffer(b"\xff".join([strings[i] for i in chosen.tolist()]), np.uint8)
        text = np.zeros(len(joined) + 1, np.int16)
        text[:-1] = joined
        text[:-1] += 1
        ends = np.cumsum(sizes[chosen] + 1) - 1
        begins = ends - sizes[chosen]
        n = counts[chosen]
        starts = np.repeat(begins, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ranked = suffix_array(text, 257, length)[1:]
        classes = repeats(joined, starts, ranked, length)
        best = np.full(classes.max() + 1, LAST_ID, np.int64)
        base = np.repeat(np.cumsum(counts) - counts, counts)[np.repeat(several, counts)]
        where = base + (starts - np.repeat(begins, n))
        np.minimum.at(best, classes, owner[where])
        owner[where] = best[classes]
    string = np.repeat(np.arange(len(strings)), counts)
    inside = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
    new = np.ones(len(string), bool)
    new[1:] = (string[1:] != string[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return string[first], inside[first], np.diff([*first, len(string)]), owner[first]


def _owner_rows(length: int):
    """Rows (block, data): for each block, whose its surroundings' strings are first."""

    def run(batches):
        for group in batches_by(batches, "shard"):
            tables = [_unpack(d) for d in group.column("data").to_pylist()]
            block = np.repeat(group.column("block").to_numpy(), [t.num_rows for t in tables])
            table = pa.concat_tables(tables)
            number, anchor, low, high = (table.column(c).to_numpy() for c in ("number", "anchor", "low", "high"))
            # Equal surroundings of several blocks are one string, with its first owner.
            coded = table.column("bytes").combine_chunks().dictionary_encode()
            kind, strings = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            owners = np.full(len(strings), LAST_ID, np.int64)
            np.minimum.at(owners, kind, low)
            anchors = np.zeros(len(strings), np.uint64)
            anchors[kind] = anchor
            string, start, count, owner = first_owners(anchors, owners, strings, length)
            # Each message gets the runs of its kind of surroundings.
            begin = np.searchsorted(string, kind)
            many = np.searchsorted(string, kind, side="right") - begin
            message = np.repeat(np.arange(len(kind)), many)
            run_ = np.repeat(begin, many) + np.arange(len(message)) - np.repeat(np.cumsum(many) - many, many)
            keep = owner[run_] < high[message]
            message, run_ = message[keep], run_[keep]
            rows = []
            for number_of, at in _groups(block[message]):
                answer = {
                    "number": number[message[at]],
                    "start": start[run_[at]].astype(np.int16),
                    "count": count[run_[at]].astype(np.int16),
                    "owner": owner[run_[at]],
                }
                rows.append((number_of, _pack(answer)))
            yield from _rows(rows, block=pa.int32(), data=pa.binary())

    return run


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that are covered by intervals, in order."""
    if not len(begins):
        return begins.astype(np.int64), ends.astype(np.int64)
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > reach[:-1]
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begins) - 1]])
    return begins[new], reach[last]


def _result_rows(length: int):
    """The documents of a block with their removed spans and what is left."""

    def run(left, right):
        ids, texts, whole = _block_documents(left, right)
        sizes = np.array([len(t) for t in texts], np.int64)
        # One place between documents keeps their spans apart.
        base = np.cumsum(sizes + 1) - sizes - 1
        own, answers = [], []
        for kind, data in zip(right.column("kind").to_pylist(), right.column("data").to_pylist(), strict=True):
            if kind == 2:
                own.append(_unpack(data))
            elif kind == 3:
                answers.append(_unpack(data))
        begins = ends = np.zeros(0, np.int64)
        if own and answers:
            places_, answer = pa.concat_tables(own), pa.concat_tables(answers)
            number, document, offset = (places_.column(c).to_numpy() for c in ("number", "document", "offset"))
            which, start, count, owner = (answer.column(c).to_numpy() for c in ("number", "start", "count", "owner"))
            order = np.argsort(which, kind="stable")
            which = which[order]
            begin = np.searchsorted(which, number)
            many = np.searchsorted(which, number, side="right") - begin
            place = np.repeat(np.arange(len(number)), many)
            at = order[np.repeat(begin, many) + np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)]
            keep = owner[at] < ids[document[place]]
            place, at = place[keep], at[keep]
            first = base[document[place]] + offset[place] + start[at]
            begins, ends = merged(first, first + count[at] - 1 + length)
        in_document = np.searchsorted(begins, [*base.tolist(), int(base[-1] + sizes[-1] + 1) if len(base) else 0])
        spans, kept = [], []
        for i, text in enumerate(texts):
            if whole[i]:
                spans.append([(0, len(text))] if text else [])
                kept.append(b"")
                continue
            mine = slice(in_document[i], in_document[i + 1])
            starts, stops = (begins[mine] - base[i]).tolist(), (ends[mine] - base[i]).tolist()
            spans.append(list(zip(starts, stops, strict=True)))
            left_over = zip([0, *stops], [*starts, len(text)], strict=True)
            kept.append(b"".join([text[a:b] for a, b in left_over]) if starts else text)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=ids == LAST_ID) if len(ids) else pa.array([], pa.int64()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT_DOCUMENTS
) -> DataFrame:
    """Rows (doc_id, n_bytes, spans, kept), one per row of ``docs``.

    ``spans`` are the maximal runs of bytes covered by strings of ``length`` bytes that also start
    in a document with a smaller doc_id, ``kept`` the other bytes of the UTF-8 text, null being empty.
    Rows with one doc_id do not remove from each other. Rows without doc_id come
    after all others and do not remove from each other. Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    order_id = F.coalesce("doc_id", F.lit(LAST_ID)).alias("id")
    mark = F.xxhash64("text")
    narrow = stored(
        rows.select(
            order_id,
            mark.alias("mark"),
            F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
            F.octet_length("text").alias("n"),
        ),
        "digests",
    )
    total = narrow.agg(F.sum("n")).first()[0] or 0
    n_blocks, n_buckets = (max(1, -(-total // size)) for size in (BLOCK_BYTES, BUCKET_BYTES))
    block_of = lambda id_, mark_: F.pmod(F.xxhash64(id_, mark_), F.lit(n_blocks)).cast("int")
    long_enough = narrow.filter(F.col("n") >= length)
    first = long_enough.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    again = (
        narrow.join(first.filter("rows > 1"), "digest")
        .filter("id > first")
        .select("id", "mark")
        .distinct()
        .withColumn("block", block_of("id", "mark"))
    )
    again = stored(again, "again")
    block = block_of(F.coalesce("doc_id", F.lit(LAST_ID)), mark).alias("block")
    dealt = rows.select(block, "doc_id", mark.alias("mark"), "text")

    anchors = dealt.select("block", "text").mapInArrow(
        _anchor_rows(length, anchor, n_blocks, n_buckets), "bucket int, block int, values binary, counts binary"
    )
    shared = stored(
        anchors.repartition(tasks(spark, n_buckets, 1), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_shared_rows(hot), "block int, bucket int, values binary, hot binary"),
        "anchors",
    )
    n_places = (shared.agg(F.sum(F.length("values"))).first()[0] or 0) // 4
    n_shards = max(1, -(-n_places * (2 * length - anchor) // SHARD_BYTES))

    def side(kind: int, frame: DataFrame) -> DataFrame:
        fields = {"bucket": "int", "values": "binary", "hot": "binary", "id": "long", "mark": "long", "data": "binary"}
        return frame.select(
            "block",
            F.lit(kind).alias("kind"),
            *[F.col(c) if c in frame.columns else F.lit(None).cast(t).alias(c) for c, t in fields.items()],
        )

    def with_texts(right: DataFrame, function, schema: str) -> DataFrame:
        # About a block in a task, however many there are.
        texts = dealt.mapInArrow(_text_rows, "block int, texts binary").repartition(tasks(spark, n_blocks, 1), "block")
        return texts.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(function, schema)

    # Blocks keep the same documents in the same order in both passes.
    messages = stored(
        with_texts(
            side(0, shared).unionByName(side(1, again)),
            _message_rows(length, anchor, n_buckets, n_shards),
            "shard int, block int, data binary",
        ),
        "surroundings",
    )
    owners = stored(
        messages.filter("shard >= 0")
        .repartition(tasks(spark, n_shards, 1), "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_owner_rows(length), "block int, data binary"),
        "owners",
    )
    right = (
        side(1, again)
        .unionByName(side(2, messages.filter("shard = -1")))
        .unionByName(side(3, owners))
    )
    return with_texts(
        right, _result_rows(length), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
