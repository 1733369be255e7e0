import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from lading.llm import mixing, surrogates, toxicity

from .edge import documents
from .test_mixing import targets
from .test_packing import check_places
from .test_packing import ids as token_ids
from .test_simhash import groups, plain


def test_stages_in_order(spark, data):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "surrogates", "mixing", "packing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    ids = [{r["doc_id"] for r in docs.collect()}]
    rated = {r["doc_id"]: r["toxic"] for r in toxicity.toxicity(docs, labels).collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.stored(stage(spark, now, data), "test")
        assert now.columns == docs.columns
        ids.append({r["doc_id"] for r in now.collect()})
        if name == "toxicity":
            assert ids[-1] == {i for i in ids[0] if not rated[i]}
        if name == "simhash":
            # By the definition: all pairs of plain fingerprints of three-word shingles.
            fps = {r["doc_id"]: plain(r["text"], 3) for r in before.collect()}
            assert ids[-1] == set(groups(fps, 2).values()) and len(ids[-1]) < len(fps)
        if name == "surrogates":
            assert now.count() == before.count()
            assert {r["text"] for r in now.collect()} == {r["text"] for r in surrogates.replaced(before).collect()}
        if name == "mixing":
            copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
            assert now.count() == sum(copies.values()) and ids[-1] == {i for i, c in copies.items() if c}
            assert max(copies.values()) <= 3
            words = {r["doc_id"]: (r["source"], len((r["text"] or "").encode().split())) for r in before.collect()}
            taken, size = Counter(), Counter()
            for i, (source, n) in words.items():
                taken[source] += n * copies[i]
                size[source] += n
            longest = max(n for _, n in words.values())
            sources = sorted(size, key=str.encode)
            for source, target in zip(sources, targets([size[s] for s in sources]), strict=True):
                assert abs(taken[source] - target) <= longest / 2
    last = corpus_pipeline.STAGES[-1][1](spark, now, data)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = sorted(map(tuple, last.select(*key).collect()))
    tokenizer, expected = Tokenizer.from_file(corpus_pipeline.TOKENIZER), []
    for r in now.collect():
        made = token_ids(tokenizer, r["text"])
        for piece, at in enumerate(range(0, len(made), 2048)):
            part = np.array(made[at : at + 2048], "<u4")
            expected.append((r["doc_id"], piece, at, len(part), zlib.crc32(part.tobytes())))
    assert rows == sorted(expected)
    check_places(last.collect(), 2048)
    assert rows == sorted(map(tuple, corpus_pipeline.run(spark, data).select(*key).collect()))


@pytest.mark.parametrize("rows", [None, []])
def test_edge_rows_go_through_every_stage(spark, data, rows):
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, data), "test")
        assert docs.columns == columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert bool(packed) == (rows is None)
