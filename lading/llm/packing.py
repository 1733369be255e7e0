"""Packing token sequences by vector best fit.

Every sequence has three capacities: tokens, documents and attention cost (the sum of
the squared lengths of its pieces). A piece goes where all three suffice, into the
sequence whose residual vector it fills best.
"""

from __future__ import annotations

import functools
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import batches_by, stored, tasks

SEQUENCE_TOKENS = 2048

# Pieces that are packed together: large enough that part-filled sequences at its end do not count.
GROUP_PIECES = 20_000

# Spellings a Python worker remembers.
CACHE_WORDS = 200_000
# Letters up to the end of the Cyrillic block are taken to be the same for all libraries.
LAST_LETTER = "\u052f"
# Signs that are split off the end of a word when they follow a letter.
SIGNS = b".,;:!?%$&#*|)"
# Ids that leave a task together.
BATCH_IDS = 2_000_000


class Known(dict):
    """What is found by ``learn`` on first use and remembered while there is room.

    Frequent words come early and so stay.
    """

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, key: bytes) -> bytes:
        found = self.learn(key)
        if len(self) < CACHE_WORDS:
            self[key] = found
        return found


class Encoder:
    """Token ids of texts; words between ASCII white space are encoded once and remembered.

    Only for tokenizers that split at white space and between letters and signs, drop white space
    and ignore case, so that the ids of a text are those of its words in turn, and those of a word
    the ids of its letters and of the signs after them.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The usual stand-in letters for bytes: printable ones stand for themselves.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_letters = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.direct = True
        self.direct = self._takes_letters()
        self.stems = Known(self._stem)
        self.words = Known(self._word)

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stem(self, stem: bytes) -> bytes:
        letters = self._letters(stem)
        if letters is None:
            return self._ids(stem.decode())
        ids = [token.id for token in self.tokenizer.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _letters(self, stem: bytes) -> str | None:
        """What the model itself gets for a stem of letters alone; None if that is not certain."""
        if not self.direct:
            return None
        text = stem.decode()
        if text.isascii():
            return text.lower() if text.isalpha() else None
        # Letter by letter: the library knows no final sigma.
        text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        if not text.isalpha() or max(text) > LAST_LETTER:
            return None
        return text.encode().decode("latin-1").translate(self.byte_letters)

    def _takes_letters(self) -> bool:
        """Whether a word of letters reaches the model as one piece, its bytes as letters."""
        for probe in ("word", "Über", "ÉTÉ", "ñandú", "слово", "λόγος", "x"):
            if self._stem(probe.encode()) != self._ids(probe):
                return False
        return True

    def _word(self, word: bytes) -> bytes:
        # A word that may hold a special token's string is encoded as it is.
        if word[-1] in SIGNS and b"<|" not in word:
            stem = word.rstrip(SIGNS)
            if stem and self._ends_in_letter(stem):
                return self.stems[stem] + self.stems[word[len(stem) :]]
        return self._ids(word.decode()) if b"<|" in word else self.stems[word]

    @staticmethod
    def _ends_in_letter(stem: bytes) -> bool:
        """Whether signs after the stem are certain to be split off: some letters become more than a letter."""
        last = stem.decode()[-1]
        low = unicodedata.normalize("NFC", last.lower())
        return last <= LAST_LETTER and len(low) == 1 and low.isalpha()

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of a text, followed by the id 0."""
        # bytes.split() without an argument splits at the six ASCII white-space bytes. Case does
        # not matter, unless lower case could spell a special token.
        words = (text if b"<|" in text else text.lower()).split()
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)) + bytes(4), "<u4")


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker: what it remembers serves all tasks the worker runs."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, most: int = SEQUENCE_TOKENS) -> DataFrame:
    """Rows (doc_id, row, piece, start, length, ids_crc32, ids): every text cut into pieces.

    A document is the ids of its text and a final 0. Only a document of more than ``most`` ids
    is cut, into pieces of ``most`` ids and a shorter last one. A null text is empty, its
    document the id 0 alone. ``row`` tells rows with the same doc_id apart.
    """

    def run(batches):
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            ids, rows, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            made, size = [], 0
            for place, row in enumerate(rows):
                found = encode((texts[place].as_py() or "").encode("utf-8", "replace"))
                for piece, start in enumerate(range(0, len(found), most)):
                    part = found[start : start + most]
                    made.append((place, row, piece, start, len(part), zlib.crc32(part), part.tobytes()))
                size += len(found)
                if size > BATCH_IDS:
                    yield _piece_batch(ids, made)
                    made, size = [], 0
            if made:
                yield _piece_batch(ids, made)

    return docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text"
    ).mapInArrow(
        run,
        "doc_id long, row long, piece int, start long, length long, ids_crc32 long, ids binary",
    )


def _piece_batch(ids: pa.Array, made: list[tuple]) -> pa.RecordBatch:
    places, *columns = zip(*made, strict=True)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(places)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
        names=["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"],
    )


def best_fit(
    lengths: np.ndarray, tokens: int, documents: int, cost: float, by: str = "residual"
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; longest pieces first.

    Of the open sequences with room in every capacity, ``dot`` takes the one with the largest
    product of the piece's and the residual vector, ``residual`` the one whose residual
    vector would be shortest. Coordinates are shares of their capacity, so their weights are
    equal; ties go to the sequence opened first. A piece that no sequence can hold beside
    others opens its own.
    """
    order = np.argsort(-lengths, kind="stable")
    place = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    room = np.zeros((1024, 3))
    number = np.zeros(1024, np.int64)
    filled = np.zeros(1024, np.int64)
    # Longest first: an open sequence holds a piece at least as long as the next one, so one of
    # more than half the tokens fits in none.
    half = tokens // 2
    n_open = n_made = 0
    least = lengths.min() if len(lengths) else 0
    for i in order.tolist():
        size = int(lengths[i])
        need = np.array([size / tokens, 1 / documents, size * size / cost])
        best = -1
        if n_open and size <= half:
            left = room[:n_open] - need
            fits = (left > -1e-9).all(axis=1)
            if fits.any():
                at = np.flatnonzero(fits)
                if by == "dot":
                    score = -(room[at] @ need)
                else:
                    score = (left[at] ** 2).sum(axis=1)
                ties = at[score <= score.min() + 1e-12]
                best = int(ties[np.argmin(number[ties])])
        if best < 0:
            if n_open == len(room):
                room = np.concatenate([room, np.zeros_like(room)])
                number = np.concatenate([number, np.zeros_like(number)])
                filled = np.concatenate([filled, np.zeros_like(filled)])
            best, n_open, n_made = n_open, n_open + 1, n_made + 1
            room[best], number[best], filled[best] = 1.0, n_made - 1, 0
        place[i], offset[i] = number[best], filled[best]
        room[best] -= need
        filled[best] += size
        # A sequence without room for the shortest piece is closed: the last open one takes its slot.
        if tokens - filled[best] < least or room[best].min() < 1e-9:
            n_open -= 1
            room[best], number[best], filled[best] = room[n_open], number[n_open], filled[n_open]
    return place, offset


def pack(
    cut: DataFrame,
    tokens: int = SEQUENCE_TOKENS,
    documents: int | None = None,
    cost: float | None = None,
    by: str = "residual",
) -> DataFrame:
    """Add sequence_id and offset to pieces; their number of rows is kept.

    Pieces are dealt by a hash over groups of about ``GROUP_PIECES``, which are packed by
    themselves; a source or document of any size is spread over them. Without ``documents``
    and ``cost`` these capacities are as large as the tokens allow.
    """
    documents = documents or tokens
    cost = cost or float(tokens) * tokens

    def run(batches):
        for group in batches_by(batches, "_group"):
            lengths = group.column("length").to_numpy()
            keys = [group.column(c).to_numpy() for c in ("ids_crc32", "piece", "_key")]
            order = np.lexsort(keys)
            place, offset = best_fit(lengths[order], tokens, documents, cost, by)
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            number = (group.column("_group")[0].as_py() << 32) + place[back]
            out = group.drop_columns(["_group", "_key"])
            out = out.append_column("sequence_id", pa.array(number, pa.int64()))
            out = out.append_column("offset", pa.array(offset[back], pa.int64()))
            yield from out.to_batches()

    n_groups = max(1, -(-cut.count() // GROUP_PIECES))
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32", "row")
    dealt = (
        cut.withColumn("_key", key)
        .withColumn("_group", F.pmod("_key", F.lit(n_groups)))
        .repartition(tasks(cut.sparkSession, n_groups, 1), "_group")
        .sortWithinPartitions("_group")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer_path: str, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) for all texts.

    Null and empty texts give one piece of length 1. Rows that repeat a doc_id, or have none, are
    documents of their own. Extra columns are not read.
    """
    cut = pieces(docs, tokenizer_path, tokens).drop("ids")
    return pack(stored(cut, "pieces"), tokens).drop("row")


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows (sequence_id, length, ids): the packed sequences themselves, ids little-endian.

    ``cut`` are stored pieces with ids, ``placed`` the same pieces after ``pack``.
    """
    where = placed.select("row", "piece", "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (
        cut.select("row", "piece", "length", "ids")
        .join(where, ["row", "piece"])
        .groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
            F.aggregate(
                "parts", F.unhex(F.lit("")), lambda ids, p: F.concat(ids, p["ids"])
            ).alias("ids"),
        )
    )
