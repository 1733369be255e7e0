import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lading.llm import packing
from lading.llm.common import stored
from lading.llm.queries import QUERIES

from .edge import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "a b c\u0085d", "é x ́y", "ẛ̣ İ İ", "a\x1cb\x1db", "", "   ",
    "ﬁ ² it's I'LL don't!!1 23", "\x00a ﻿b", "漢字 かな 👍🏽 a", "ΟΔΟΣ. ΟΔΟΣ.Α x..y. a) ). é. ²., ǅ ß ſ",
]


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_is_the_tokenizer(data, spark):
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    assert encoder.direct
    texts = [r[0] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    for text in HARD + texts:
        assert encoder.encode(text.encode()).tolist() == ids(tokenizer, text)


def test_signs_after_every_letter():
    # Every code point up to the last letter that is looked at by itself, and others at random.
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    signs, rnd = packing.SIGNS.decode(), random.Random(1)
    chars = [chr(c) for c in range(0x20, ord(packing.LAST_LETTER) + 1)]
    others = [chr(c) for c in rnd.sample([c for c in range(0x530, 0x110000) if not 0xD800 <= c < 0xE000], 3000)]
    texts = [f"{c}{s} a{c}{s}b{c} {s}{c}" for c in chars for s in signs]
    texts += [f"{c}{s} a{c}{s}{s}" for c in others for s in rnd.sample(signs, 2)]
    pool = [*chars, *"\u0130\u0131\u00df\u017f\u01c5\u03a3\u03c2GAZ\u0130.,;:!?%$&#*|) \t'" * 6, "\u0301", "\u0307"]
    texts += ["".join(rnd.choices(pool, k=rnd.randint(1, 12))) for _ in range(5000)]
    texts += ["GAZ\u0130.", "BELED\u0130YES\u0130, ANKARA", "\u0130stanbul"]
    for text, made in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text.encode()).tolist() == [*made.ids, 0], ascii(text)


def test_best_fit_holds_every_capacity():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 101, 3000)
    for by in ("residual", "dot"):
        place, offset = packing.best_fit(lengths, 100, 4, 4000.0, by)
        for number in np.unique(place):
            mine = np.flatnonzero(place == number)
            order = mine[np.argsort(offset[mine])]
            assert offset[order].tolist() == (np.cumsum(lengths[order]) - lengths[order]).tolist()
            assert lengths[mine].sum() <= 100 and len(mine) <= 4
            assert len(mine) == 1 or (lengths[mine] ** 2).sum() <= 4000 + 1e-6
    place, _ = packing.best_fit(lengths, 100, 100, 1e4)
    assert place.max() + 1 <= 1.03 * lengths.sum() / 100 + 1


def test_query_on_whole_table(spark, data):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op7_packing"](spark, data).collect()
    expected = []
    for i, text in docs:
        made = ids(tokenizer, text)
        for piece, at in enumerate(range(0, len(made), 2048)):
            part = made[at : at + 2048]
            expected.append((i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    check_places(rows, 2048)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 2


def check_places(rows, most):
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= most


def test_edge_rows(spark):
    rows = packing.packed(documents(spark), PATH, 64).collect()
    check_places(rows, 64)
    assert sorted((r["doc_id"], r["length"]) for r in rows if r["doc_id"] in (3, 4, 5)) == [(3, 1), (4, 1), (5, 1)]
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 2 * sum(r["length"] for r in rows if r["doc_id"] == 1)
    assert packing.packed(documents(spark, []), PATH).collect() == []


def test_sequences_hold_the_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 10)
    docs = documents(spark)
    cut = stored(packing.pieces(docs, PATH, 64), "pieces")
    placed = stored(packing.pack(cut.drop("ids"), 64), "placed")
    made = {r["sequence_id"]: r for r in packing.sequences(cut, placed).collect()}
    where = {(r["row"], r["piece"]): (r["sequence_id"], r["offset"]) for r in placed.collect()}
    for r in cut.collect():
        number, offset = where[r["row"], r["piece"]]
        assert bytes(made[number]["ids"])[4 * offset :][: len(r["ids"])] == bytes(r["ids"])
        assert made[number]["length"] <= 64
