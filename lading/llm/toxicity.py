"""Toxicity by cumulative-link ordinal regression on sparse word features.

Severity beyond toxic is a proxy: labels say only whether a text is toxic, and of the toxic texts those with
more telling words than the median one that has any count as severe. The grades are 0 harmless, 1 toxic,
2 severe. The model gives
P(grade <= k) = sigmoid(threshold_k - score), one score per text from weights that all
thresholds share, so every grade boundary learns from all labelled rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.common import stored

GRADES = 3

# Bound of the labelled rows that a model is fitted to, and of the words it weighs.
SAMPLE_ROWS = 12_000
FEATURES = 2_000

# A word is weighed if its share of toxic and of harmless texts differ by this many standard errors.
LEAST_Z = 4.0
RIDGE = 1e-4

# One feature is a run of letters, in lower case.
_TOKEN = r"\p{L}+"


def words(text: Column) -> Column:
    """The distinct words of a text; none for null."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({_TOKEN})"))
    return F.array_distinct(found)


@dataclass
class Model:
    vocabulary: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """One column per grade."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)


def marks(labels: DataFrame) -> DataFrame:
    """Rows (doc_id, toxic as 0 or 1) from labels.

    Labels without id or without a toxic mark are left out. An id is toxic if any of
    its rows is.
    """
    return (
        labels.filter("doc_id is not null and toxic is not null")
        .select(F.col("doc_id").cast("long"), (F.col("toxic") != 0).cast("int").alias("toxic"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def severities(toxic: np.ndarray, n_telling: np.ndarray) -> np.ndarray:
    """The grade of every labelled text from its label and its number of telling words."""
    some = n_telling[(toxic > 0) & (n_telling > 0)]
    middle = np.median(some) if len(some) else 0
    return np.where(toxic == 0, 0, np.where(n_telling > middle, 2, 1))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Fit to a fixed choice, by a hash of the id, of at most ``sample_rows`` labelled texts.

    The words are counted in Spark; the driver receives the counts of the ``features`` most
    telling ones and, per sampled text, which of these it has. Labels without document
    do not count. Without labels, or with one grade only, nothing is toxic.
    """
    known = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    chosen = (
        marks(labels)
        .join(known.select("doc_id").distinct(), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # Bounded by sample_rows pairs of numbers, so every task may hold them.
    marked = (
        known.join(F.broadcast(stored(chosen, "sample")), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    )
    sample = stored(marked.select("doc_id", "toxic", words(F.col("text")).alias("words")), "words")
    n, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not toxic or toxic == n:
        only = 0.0 if not toxic else 40.0
        return Model([], np.zeros(0), np.array([-only + 40 * (not toxic), 41.0]))
    harmless = n - toxic
    per_word = (
        sample.select(F.explode("words").alias("word"), F.col("toxic").alias("t"))
        .groupBy("word")
        .agg(F.sum("t").alias("in_toxic"), F.count("*").alias("n"))
    )
    share = F.col("n") / float(n)
    gap = F.col("in_toxic") / float(toxic) - (F.col("n") - F.col("in_toxic")) / float(harmless)
    error = F.sqrt(share * (1 - share) * (1 / float(toxic) + 1 / float(harmless)) + 1e-12)
    telling = (
        per_word.filter("n >= 3")
        .withColumn("z", F.abs(gap) / error)
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "word")
        .limit(features)
    )
    vocabulary = sorted(r["word"] for r in telling.collect())
    place = {w: i for i, w in enumerate(vocabulary)}
    has = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary])) if vocabulary else F.array()
    rows = sample.select("doc_id", "toxic", has.cast("array<string>").alias("has")).orderBy("doc_id").collect()
    index = [[place[w] for w in r["has"]] for r in rows]
    grade = severities(np.array([r["toxic"] for r in rows]), np.array([len(i) for i in index]))
    weights, thresholds = train(index, grade, len(vocabulary))
    return Model(vocabulary, weights, thresholds)


def train(
    index: list[list[int]], grade: np.ndarray, n_features: int, steps: int = 400
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds that maximise the penalised likelihood.

    ``index`` has the features that are present in each row. Plain gradient steps with
    per-coordinate scaling; the distances between thresholds are kept positive by their logarithm.
    """
    rows = np.repeat(np.arange(len(index)), [len(i) for i in index])
    cols = np.array([j for i in index for j in i], np.int64)
    weights = np.zeros(n_features)
    share = [(np.sum(grade <= k) + 0.5) / (len(grade) + 1) for k in range(GRADES - 1)]
    first = [math.log(p / (1 - p)) for p in share]
    base, gaps = first[0], np.log(np.maximum(np.diff(first), 1e-3))
    moments = np.zeros((2, n_features + GRADES - 1))
    n = len(grade)
    for step in range(1, steps + 1):
        score = np.bincount(rows, weights[cols], minlength=n) if n_features else np.zeros(n)
        limits = np.concatenate([[-np.inf], base + np.concatenate([[0], np.cumsum(np.exp(gaps))]), [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(limits[grade + 1] - score, -500, 500)))
        lower = 1 / (1 + np.exp(-np.clip(limits[grade] - score, -500, 500)))
        mass = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        g_score = d_upper - d_lower
        g_weights = np.bincount(cols, g_score[rows], minlength=n_features) / n + RIDGE * weights
        g_limit = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            g_limit[k] = (-d_upper[grade == k].sum() + d_lower[grade == k + 1].sum()) / n
        g_gaps = np.array([g_limit[k + 1 :].sum() * math.exp(gaps[k]) for k in range(GRADES - 2)])
        gradient = np.concatenate([g_weights, [g_limit.sum()], g_gaps])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights = weights - move[:n_features]
        base -= move[n_features]
        gaps = gaps - move[n_features + 1 :]
    return weights, base + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, severity, grade, toxic), one per row of ``docs``.

    ``severity`` is the expected grade, ``grade`` the highest that is likelier to be reached than
    not, ``toxic`` whether that is above 0. Null and empty texts have the severity of a
    text without telling words; a null doc_id stays null. Extra columns are not read.
    """
    rated = _rated(model)
    fields = "severity double, grade int, toxic boolean"

    def run(batches):
        for batch in batches:
            severity, grade = rated(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(severity), pa.array(grade), pa.array(grade > 0)],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {fields}"
    )


def _rated(model: Model):
    """Severity and grade of an Arrow column of texts. The model is bounded by its features."""
    weight = dict(zip(model.vocabulary, model.weights.tolist(), strict=True))
    # Runs of letters: neither digits nor underscores.
    token = re.compile(r"[^\W\d_]+")

    def rated(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        scores = np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = weight.keys() & token.findall((text.as_py() or "").lower())
            scores[i] = sum(weight[w] for w in sorted(found))
        odds = model.probabilities(scores)
        severity = odds @ np.arange(GRADES)
        reached = 1 - np.cumsum(odds, axis=1)[:, :-1] > 0.5
        return severity, reached.sum(axis=1).astype(np.int32)

    return rated


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit to ``labels`` and score all of ``docs``; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels))


def harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, unchanged."""
    rated = _rated(fit(docs, labels))
    text = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            _, grade = rated(batch.column(text))
            yield batch.filter(pa.array(grade == 0))

    return docs.mapInArrow(run, docs.schema)
