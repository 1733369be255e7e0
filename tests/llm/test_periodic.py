import hashlib
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from lading.llm import periodic
from lading.llm.queries import QUERIES, planted_repeats

from .edge import documents


def plain_lyndon(symbols):
    """Longest Lyndon word from every place, by comparing it with its suffixes."""
    found = []
    for i in range(len(symbols)):
        words = [symbols[i:j] for j in range(i + 1, len(symbols) + 1)]
        found.append(max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return found


def plain_runs(words, least, periods):
    """All runs, by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, periods * q):
                # The smallest period of a stretch comes first.
                found.setdefault((i, length), q)
            i = j
    return sorted((i, length, q) for (i, length), q in found.items())


def sequences(count, seed=3):
    rnd = random.Random(seed)
    for _ in range(count):
        kind = rnd.randrange(4)
        size = rnd.randint(0, 70)
        letters = rnd.choice([1, 2, 2, 3, 8])
        words = [rnd.randrange(letters) for _ in range(size)]
        if kind == 1 and size:
            unit = words[: rnd.randint(1, size)]
            words = (unit * 20)[: rnd.randint(0, 90)] + words
        if kind == 2 and size > 3:
            unit = words[:3] * 3 + [rnd.randrange(3)]
            words = words + unit * 4 + words[:5] + unit * 3
        if kind == 3:
            a, b = [0], [0, 1]
            for _ in range(rnd.randint(2, 7)):
                a, b = b, b + a
            words = b[:90]
        yield words


def test_lyndon_groups():
    for words in sequences(250):
        distinct = sorted(set(words))
        symbols = [distinct.index(w) for w in words]
        group, length = periodic.lyndon_groups(symbols)
        assert length.tolist() == plain_lyndon(symbols)
        by_group = {}
        for i, (g, n) in enumerate(zip(group, length, strict=True)):
            assert by_group.setdefault(g, symbols[i : i + n]) == symbols[i : i + n]
        assert len({tuple(w) for w in by_group.values()}) == len({g for g in group})


@pytest.mark.parametrize("least,periods", [(24, 3), (6, 3), (3, 3), (9, 4), (1, 3)])
def test_runs_against_all_periods(least, periods):
    hits = 0
    for words in sequences(400, seed=least):
        named = [b"w%d" % w for w in words]
        expected = plain_runs(named, least, periods)
        assert periodic.word_runs(named, least, periods) == expected
        assert periodic.maximal_runs(np.array(words, np.int64), least, periods) == expected
        hits += len(expected)
    assert hits > 50


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.word_runs([b"a"] * 9, 4, 2)


def plain_query(doc_id, text):
    words = [w for w in (text or "").translate({i: " " for i in range(9, 14)}).split(" ") if w]
    words = [w.decode() for w in planted_repeats(doc_id, [w.encode() for w in words])]
    runs = plain_runs(words, 24, 3)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(left.encode()).hexdigest(),
    )


def test_query_on_whole_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op12_periodic"](spark, data).collect()
    # The plain way is quadratic: very long texts are compared by the tests above.
    short = {r[0] for r in rows if len(r[1] or "") < 12_000}
    assert len(found) == len(rows) and len(short) > 0.9 * len(rows)
    expected = sorted((plain_query(*r) for r in rows if r[0] in short), key=repr)
    assert sorted((tuple(r) for r in found if r[0] in short), key=repr) == expected
    assert sum(r[1] > 0 for r in expected) >= 10


def test_edge_rows(spark):
    docs = documents(spark)
    found = periodic.periodic_runs(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    for row in found:
        if row["doc_id"] in (3, 4, 5):
            assert (row["n_words"], row["runs"], row["collapsed"]) == (0, [], "")
        if row["doc_id"] == 6:
            # 97 words that come again and again.
            assert [tuple(r) for r in row["runs"]] == [(0, 30_000, 97)]
            assert row["collapsed"].split() == [f"word{i}" for i in range(97)]
        if row["doc_id"] == 7:
            assert row["collapsed"].split()[-1] == "end" and row["n_words"] == 30_001
    assert periodic.periodic_runs(documents(spark, [])).collect() == []


def test_strongest(spark):
    rows = [([(0, 30, 10), (5, 60, 20), (9, 24, 2), (40, 48, 4)],), ([],), ([(1, 24, 8), (2, 6, 2)],)]
    frame = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    from pyspark.sql import functions as F

    best = [r[0] for r in frame.select(periodic.strongest(F.col("runs"))).collect()]
    assert [tuple(b) if b else None for b in best] == [(9, 24, 2), None, (1, 24, 8)]
