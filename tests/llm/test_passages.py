import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lading.llm import passages
from lading.llm.queries import QUERIES
from lading.llm.suffix import repeats, suffix_array

SCHEMA = "doc_id long, text string, kept string, spans int"


def brute(rows, length):
    """(doc_id, n_bytes, spans, kept) of every row, by the definition."""
    last = 1 << 63
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for i, t in data:
        key = last if i is None else i
        for at in range(len(t) - length + 1):
            s = t[at : at + length]
            first[s] = min(first.get(s, last), key)
    out = []
    for i, t in data:
        key = last if i is None else i
        covered = bytearray(len(t))
        for at in range(len(t) - length + 1):
            if first[t[at : at + length]] < key:
                covered[at : at + length] = b"\1" * length
        spans, start = [], None
        for at, c in enumerate([*covered, 0]):
            if c and start is None:
                start = at
            if not c and start is not None:
                spans.append((start, at))
                start = None
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        out.append((-1 if i is None else i, len(t), tuple(spans), kept))
    return sorted(out)


def found(frame):
    return sorted(
        (-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"]))
        for r in frame.collect()
    )


def fixture():
    rnd = random.Random(3)
    words = ["ab", "abc", "é", "aaaa", "b", "ca", "ÿ", "aaaaaaaa"]
    rows = []
    for i in range(60):
        text = "".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
        if i % 7 == 3:
            text = rows[rnd.randrange(len(rows))][1]
        if i % 11 == 5:
            text = (rows[2][1] or "") + text + (rows[1][1] or "")
        rows.append((i, text, "x", 1))
    rows += [(None, rows[4][1], None, None), (None, "zzzzzzzzzzzzzzzz", None, None), (None, "zzzzzzzzzzzzzzzz", None, 2)]
    rows += [(70, None, None, None), (71, "", None, None), (5, rows[5][1], "again", 0), (6, "other text of a repeated id", "", 0)]
    rows += [(80, "a" * 3000, None, None), (81, "b" + "a" * 2500, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [3, 20_000])
def test_against_brute_force(spark, hot):
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(passages.without_repeats(docs, 12, 6, hot)) == brute(rows, 12)


def test_small_blocks_and_shards(spark, monkeypatch):
    rows = fixture()
    for name, size in (("BLOCK_BYTES", 1000), ("BUCKET_BYTES", 2000), ("SHARD_BYTES", 1500), ("CHUNK_BYTES", 700)):
        monkeypatch.setattr(passages, name, size)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(passages.without_repeats(docs, 10, 5)) == brute(rows, 10)


def test_empty(spark):
    assert passages.without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(passages.without_repeats(only)) == [(1, 0, (), b""), (2, 0, (), b"")]


def test_query_on_whole_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = [
        (i, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, n, spans, kept in brute([(r[0], r[1]) for r in rows], 50)
    ]
    result = QUERIES["op5_passages"](spark, data)
    assert dict(result.dtypes)["n_spans"] == "bigint"
    assert sorted(map(tuple, result.collect())) == expected
    assert result.agg(F.sum("n_removed")).first()[0] > 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    for trial in range(120):
        symbols = int(rng.integers(1, 5))
        body = rng.integers(1, symbols + 1, int(rng.integers(0, 150)))
        if trial % 3 == 0:
            body = np.tile(body[:7], 12)
        text = np.concatenate([body, [0]]).astype(np.int16)
        data = bytes(text.astype(np.uint8))
        assert suffix_array(text, symbols + 1, 10**6).tolist() == sorted(
            range(len(data)), key=lambda i: data[i:]
        )


def test_repeats():
    data = np.frombuffer(b"abcdefghijk-abcdefghijk-abcdefghiXk", np.uint8)
    text = np.concatenate([data.astype(np.int16) + 1, [0]])
    starts = np.arange(len(data) - 7)
    classes = repeats(data, starts, suffix_array(text, 257, 8)[1:], 8)
    for a in starts:
        for b in starts:
            same = data[a : a + 8].tobytes() == data[b : b + 8].tobytes()
            assert same == (classes[a] == classes[b])
