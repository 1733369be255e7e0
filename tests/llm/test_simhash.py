import random

import pytest
import xxhash

from lading.llm import simhash
from lading.llm.queries import QUERIES

from .edge import documents


def plain(text, n):
    """The fingerprint by its definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, radius):
    """Smallest id reachable by links of at most ``radius`` bits, by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", None, "A b", "É Ü a b c\x1cd e", "a\tb\nc d  e", "x " * 50, "The the THE tHe"])
def test_fingerprint(text):
    for n in (3, 5):
        assert simhash.fingerprint(text, n) == plain(text, n)


@pytest.mark.parametrize("limit", [256, 2])
def test_links_against_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", limit)
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {}
    for i in range(400):
        value = rnd.choice(base)
        for _ in range(rnd.randint(0, 3)):
            value ^= 1 << rnd.randrange(64)
        fps[i] = value
    first = {}
    for i, v in sorted(fps.items()):
        first.setdefault(v, i)
    rows = [(v - (1 << 64) if v >> 63 else v, i) for v, i in first.items()]
    edges = simhash.links(spark.createDataFrame(rows, "fp long, first_doc long"), 2)
    found = {r["node"]: r["component"] for r in simhash.components(edges).collect()}
    expected = groups({i: v for v, i in first.items()}, 2)
    assert {i: found.get(i, i) for i in expected} == expected


def test_query_on_whole_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    fps = {r[0]: plain(r[1], 3) for r in rows}
    expected = groups(fps, 2)
    found = QUERIES["op2_simhash"](spark, data).collect()
    assert sorted(map(tuple, found)) == sorted((i, f"{fps[i]:016x}", c) for i, c in expected.items())


def test_edge_rows(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    assert len(rows) == 13
    component = {(r["doc_id"], r["fp"]): r["component_id"] for r in rows}
    assert {r["component_id"] for r in rows if r["fp"] == 0 and r["doc_id"] is not None} == {3}
    assert {c for (i, _), c in component.items() if i in (1, 2)} == {1}
    assert {c for (i, _), c in component.items() if i == 8} == {8}
    assert all(c is None for (i, _), c in component.items() if i is None)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_representatives(spark):
    rnd = random.Random(2)
    rows = []
    for group in range(25):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
        for copy in range(4):
            changed = list(words)
            if copy:
                changed[rnd.randrange(400)] = f"x{rnd.randrange(10**6)}"
            rows.append((group * 4 + copy, " ".join(changed), "en", "a"))
    kept = simhash.representatives(documents(spark, rows))
    expected = groups({r[0]: plain(r[1], 3) for r in rows}, 2)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))
    assert len(set(expected.values())) < 100 and kept.columns == documents(spark, []).columns
    edge = simhash.representatives(documents(spark))
    # Of 1 and 2 the first stays, of the blank 3, 4, 5 too; 7 repeats 6; rows without id stay.
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in edge.collect()) == [-1, -1, 1, 3, 6, 8, 8, 9]
    assert simhash.representatives(documents(spark, [])).collect() == []
