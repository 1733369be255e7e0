import numpy as np
from pyspark.sql import functions as F

from lading.llm import toxicity
from lading.llm.queries import QUERIES

from .edge import documents


def test_training_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    index = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(3000)]
    true = np.array([2.0, 2.0, 2.0, 0.0, 0.0, 0.0])
    score = np.array([true[i].sum() for i in index]) + rng.logistic(size=3000)
    grade = np.digitize(score, [1.0, 4.0])
    weights, thresholds = toxicity.train(index, grade, 6)
    assert thresholds[0] < thresholds[1]
    assert weights[:3].min() > 1.4 and np.abs(weights[3:]).max() < 0.4


def test_probabilities_follow_the_links():
    model = toxicity.Model(["bad"], np.array([3.0]), np.array([1.0, 4.0]))
    odds = model.probabilities(np.array([0.0, 3.0, 6.0]))
    below = 1 / (1 + np.exp(-(np.array([[1.0, 4.0]]) - np.array([[0.0], [3.0], [6.0]]))))
    assert np.allclose(odds.sum(axis=1), 1) and np.allclose(np.cumsum(odds, axis=1)[:, :2], below)
    assert (np.diff(odds @ np.arange(3)) > 0).all()


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0
    model = toxicity.fit(docs, labels.filter(~held))
    scored = toxicity.score(docs, model).withColumnRenamed("toxic", "found")
    rows = scored.join(labels.filter(held), "doc_id").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert len(rows) > 800
    assert sum(r["found"] for r in clean) <= 0.01 * len(clean)
    assert sum(r["found"] for r in toxic) >= 0.75 * len(toxic)
    assert all(r["found"] == (r["grade"] > 0) and 0 <= r["severity"] <= 2 for r in rows)


def test_query_and_stage_agree(spark, data):
    rows = QUERIES["op8_toxicity"](spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert rows.count() == docs.count()
    kept = toxicity.harmless(docs, spark.read.parquet(f"{data}/labels.parquet"))
    assert kept.columns == docs.columns
    clean = {r["doc_id"] for r in rows.filter("not toxic").collect()}
    assert {r["doc_id"] for r in kept.collect()} == clean


def test_edge_rows(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["toxic"] for r in toxicity.toxicity(docs, none).collect()} == {False}
    only = spark.createDataFrame([(1, 0, 1), (2, None, 1), (None, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(docs, only).collect()
    assert len(rows) == 13 and {r["toxic"] for r in rows} == {True}
    mixed = spark.createDataFrame([(i, None, i % 2) for i in range(1, 10)] + [(3, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.harmless(docs, mixed).columns == docs.columns
    assert toxicity.toxicity(documents(spark, []), mixed).collect() == []


def test_texts_of_one_id(spark):
    rows = [(i, "bad word" if i % 2 else "good word", "en", "a") for i in range(400)]
    rows += [(i, "good word" if i % 2 else "bad word", "en", "a") for i in range(0, 400, 3)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    models = [toxicity.fit(docs.repartition(n), labels) for n in (1, 5)]
    assert models[0].vocabulary == models[1].vocabulary and np.array_equal(models[0].weights, models[1].weights)
