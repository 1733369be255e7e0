import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lading.llm import divergence

from .edge import documents

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least_docs=3, most_terms=200):
    """The audit by its definition, for rows (lang, source, text)."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    seen, langs = Counter(), defaultdict(Counter)
    groups = defaultdict(Counter)
    for lang, source, terms in docs:
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        seen.update((lang, t) for t in set(terms))
    out = []
    for lang, all_counts in langs.items():
        kept = [t for t in all_counts if seen[lang, t] >= least_docs]
        sources = {s for g, s in groups if g == lang}

        def scale(counts, kept=kept):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        p = {s: scale(groups[lang, s]) for s in sources}
        q = scale(all_counts)
        far = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, most_terms)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, **options).collect()))


def corpus(n=400, seed=5):
    rnd = random.Random(seed)
    words = [f"W{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["é", "Été", "日本", "x y"]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choices(words, [1 / (j + 1) for j in range(len(words))], k=rnd.randint(0, 40)))
        rows.append((i, text + "1a-b_C", rnd.choice(["en", "de"]), rnd.choice(["hot", "hot", "a", "b", "ç"])))
    return rows


def test_against_plain_audit(spark):
    rows = corpus()
    docs = documents(spark, rows)
    expected = plain([(r[2], r[3], r[1]) for r in rows])
    assert found(docs) == expected
    assert found(docs.repartition(9)) == expected
    assert found(docs, least_docs=1, most_terms=3) == plain([(r[2], r[3], r[1]) for r in rows], 1, 3)


def test_full_blocks_and_many_runs(spark):
    rows = corpus(300, seed=8)
    docs = documents(spark, rows).repartition(6)
    expected = plain([(r[2], r[3], r[1]) for r in rows])
    # Blocks are full after a few documents; runs are merged two at a time, in several rounds and shards.
    limits = divergence.Limits(
        block_terms=50, block_entries=60, fan_in=2, piece=3, segment_bits=1, segment_entries=100, pairs=5
    )
    assert found(docs, limits=limits) == expected


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert found(docs) == plain([tuple(r) for r in docs.select("lang", "source", "text").collect()])


def test_edge_rows(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    for least in (1, 3, 99):
        assert found(docs, least_docs=least) == plain(rows, least)
    assert found(documents(spark, [])) == []
    # Languages without a kept term: sources are still compared, at distance 0.
    bare = [(1, "", "en", "a"), (2, None, "en", "b"), (3, "12 34", None, None), (4, "one", "fr", "a"), (5, "one", "fr", "b")]
    assert found(documents(spark, bare)) == [
        ("en", "a", "pair", "b", 0, 1),
        ("en", "b", "pair", "a", 0, 1),
        ("fr", "a", "pair", "b", 0, 1),
        ("fr", "b", "pair", "a", 0, 1),
    ]


@pytest.mark.parametrize("text", ["", None, "A-b C1d", "É ÉA x", "\x1cq\x85r", "[Z]@{y}~", "日本語 Ab\tcd"])
def test_terms(text):
    raw = None if text is None else text.encode()
    assert [t.decode() for t in divergence.terms(raw)] == TERM.findall((text or "").translate(LOWER))


def test_heap_merge():
    rng = np.random.default_rng(1)
    for _ in range(50):
        runs, sums = [], Counter()
        for _ in range(rng.integers(0, 9)):
            key = np.unique(rng.integers(0, rng.choice([5, 100_000]), rng.integers(0, 20_000)))
            count = rng.integers(1, 9, len(key))
            runs.append((key, count, count + 1))
            for k, c in zip(key.tolist(), count.tolist(), strict=True):
                sums[k] += c
        key, count, docs = divergence.heap_merged(runs, 1000)
        assert dict(zip(key.tolist(), count.tolist(), strict=True)) == sums and (np.diff(key) > 0).all()
        assert docs.sum() == count.sum() + sum(len(run[0]) for run in runs)
