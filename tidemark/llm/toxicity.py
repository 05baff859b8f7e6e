"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(theta_k - x.beta): one weight vector for all thresholds, thresholds in order.
Features: presence of a word (A-Z lower-cased, ASCII punctuation at its ends removed), those words whose
toxic share among labelled documents differs from the overall share by a log-likelihood ratio of
``MIN_G`` or more. The labels say toxic or not, so grades are drawn from both: 0 not toxic, 1 toxic,
2 toxic with ``SEVERE`` or more different words of those that speak for toxicity.

Fit on at most ``SAMPLE`` labelled documents (those with the smallest hash of doc_id), on the driver,
with at most ``FEATURES`` features. Everything else covers all rows: each document of the table is
scored whole, in one pass without a shuffle, with the features as a sorted array in the task.

Output: expected severity (mean grade), the probable grade, and ``toxic`` if P(grade >= 1) >= 0.5.

Edge cases: null or empty texts have no features and get the base rate; null doc_id is scored like any
other; labels with null grades are not used, repeated labels of a document count once (the worse
one); without labels of both kinds the model says 0 for all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, materialize

SAMPLE = 20_000
FEATURES = 4096
MIN_G = 20.0
SEVERE = 3
RIDGE = 0.02

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def word_features(t: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word that has more than punctuation."""
    start, end, some = tk.trimmed(t, _PUNCTUATION)
    return t.doc[some], tk.segment_hashes(_LOWER[t.bytes], start, end, 0).view(np.int64)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tk.slices(batches):
        doc, h = word_features(tk.read_texts(batch.column("text")))
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        first = np.searchsorted(doc[new], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([batch.column("grade"), tk.ragged(h[new], first, pa.int64())], ["grade", "features"])


@dataclass
class OrdinalModel:
    features: np.ndarray  # sorted hashes
    beta: np.ndarray
    theta: np.ndarray  # increasing

    def severity(self, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= k) for each threshold k."""
        over = 1 / (1 + np.exp(-np.clip(margin[:, None] - self.theta, -500, 500)))
        return over.sum(axis=1), over


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_features: int, ridge: float = RIDGE, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated gradient descent on the penalised likelihood.

    rows and columns: places of the ones in the design matrix.
    """
    n, top = len(grades), int(grades.max())
    shares = np.array([(grades >= k).mean() for k in range(1, top + 1)])
    theta = -np.log(shares / (1 - shares))
    beta = np.zeros(n_features)
    at = np.maximum(grades - 1, 0), np.minimum(grades, top - 1)
    momentum = np.zeros(n_features + top)
    squares = np.zeros(n_features + top)
    for step in range(1, steps + 1):
        margin = np.bincount(rows, beta[columns], minlength=n)
        lower = 1 / (1 + np.exp(-(theta[at[0]] - margin)))  # P(y <= g - 1)
        upper = 1 / (1 + np.exp(-(theta[at[1]] - margin)))  # P(y <= g)
        a = np.where(grades == 0, 0.0, lower)
        b = np.where(grades == top, 1.0, upper)
        p = np.maximum(b - a, 1e-12)
        da = np.where(grades == 0, 0.0, lower * (1 - lower)) / p
        db = np.where(grades == top, 0.0, upper * (1 - upper)) / p
        g_margin = db - da  # derivative of -log p by the margin
        g_beta = np.bincount(columns, g_margin[rows], minlength=n_features) + ridge * beta
        g_theta = np.bincount(at[0], da, minlength=top) - np.bincount(at[1], db, minlength=top)
        g = np.concatenate([g_beta, g_theta])
        momentum = 0.9 * momentum + 0.1 * g
        squares = 0.99 * squares + 0.01 * g * g
        move = 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
        beta = beta - move[:n_features]
        theta = np.maximum.accumulate(theta - move[n_features:])
    return beta, theta


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> OrdinalModel:
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    graded = usable.groupBy(F.col("doc_id").alias("label_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("grade"))
    chosen = graded.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("grade", "text")
    sparse = materialize(bound_batches(texts).mapInArrow(_sparse, "grade int, features array<long>"))
    totals = sparse.agg(F.count("*"), F.coalesce(F.sum((F.col("grade") > 0).cast("long")), F.lit(0))).first()
    n, n1 = totals
    if not n1 or n1 == n:
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.array([50.0]))
    counts = sparse.select((F.col("grade") > 0).cast("long").alias("y"), F.explode("features").alias("h")).groupBy("h").agg(F.count("*").alias("c"), F.sum("y").alias("c1"))
    share = n1 / n
    term = lambda k, p: F.when(k > 0, k * F.log(k / (F.col("c") * p))).otherwise(0.0)
    g = 2 * (term(F.col("c1"), share) + term(F.col("c") - F.col("c1"), 1 - share))
    best = counts.withColumn("g", g).where(F.col("g") >= MIN_G).orderBy(F.desc("g"), "h").limit(features)
    chosen_rows = sorted(best.collect(), key=lambda r: r.h)
    hashes = np.array([r.h for r in chosen_rows], np.int64)
    speaks = np.array([r.c1 > share * r.c for r in chosen_rows], bool)
    chosen_words = F.array(*(F.lit(int(h)) for h in hashes)) if len(hashes) else F.array().cast("array<long>")
    slim = sparse.select("grade", F.array_intersect("features", chosen_words).alias("f")).collect()
    rows = np.repeat(np.arange(len(slim)), [len(r.f) for r in slim])
    columns = np.searchsorted(hashes, np.array([h for r in slim for h in r.f], np.int64))
    hits = np.bincount(rows[speaks[columns]], minlength=len(slim)) if len(hashes) else np.zeros(len(slim), int)
    grades = np.array([r.grade for r in slim]) * (1 + (hits >= SEVERE))
    present = np.unique(grades)
    beta, theta = fit_ordinal(rows, columns, np.searchsorted(present, grades), len(hashes))
    return OrdinalModel(hashes, beta, theta)


def _scored(model: OrdinalModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches):
            doc, h = word_features(tk.read_texts(batch.column("text")))
            margin = np.zeros(batch.num_rows)
            if len(model.features):
                slot = np.minimum(np.searchsorted(model.features, h), len(model.features) - 1)
                hit = model.features[slot] == h
                seen = np.unique(doc[hit] * np.int64(len(model.features)) + slot[hit])
                margin = np.bincount(seen // len(model.features), model.beta[seen % len(model.features)], minlength=batch.num_rows)
            expected, over = model.severity(margin)
            p = over[:, 0]
            arrays = [batch.column("doc_id"), pa.array(expected), pa.array((over >= 0.5).sum(axis=1), pa.int32()), pa.array(p), pa.array(p >= 0.5)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "expected_severity", "grade", "p_toxic", "toxic"])

    return run


def score(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return bound_batches(slim).mapInArrow(_scored(model), "doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
