"""Operator 5: a character n-gram linear classifier on features scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams that occur in it, each counted once. From labelled texts every
feature gets the ratio r = log((p + a) / |p|) - log((q + a) / |q|) of its document counts p, q in the two classes. A
logistic model is then fitted on the features times r. Features whose ratio is within ``MIN_Z`` standard errors of 0
say nothing that can be told from chance and get no weight; the ``MOST_FEATURES`` surest ones are the model.

Fitting uses a bounded sample of labelled rows: about ``SAMPLE`` of them, by a hash of doc_id, all labels where there
are fewer. Counting is a Spark job with partial counts per partition; the driver gets those features and the sample's
few active ones. Scoring is one pass over all texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.session import cut_lineage

SIZES = (3, 5, 8)
BITS = 20
BUCKETS = 1 << BITS
#: Labelled rows that the classifier is fitted on, about, and the tasks that count them.
SAMPLE = 20_000
SAMPLE_PARTS = 16
MIN_Z = 4.0
#: Features with a weight; those whose ratios are most standard errors from 0.
MOST_FEATURES = 4096
SMOOTHING = 1.0
L2 = 1e-3
FOLDS = 5
THRESHOLD = 0.5
#: Code points that are hashed at a time; a longer text is taken in overlapping pieces.
_PIECE = 1 << 20


def features(text: str | None, among: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature numbers of a text, ascending; with ``among``, a flag per feature, only the flagged ones.

    Lower case; the text's ends count as spaces.
    """
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    found, widest = [], max(SIZES)
    for start in range(0, len(points), _PIECE):
        piece = points[start : start + _PIECE + widest - 1].astype(np.uint64)
        hashed = np.zeros(len(piece), np.uint64)
        for size in range(1, min(widest, len(piece)) + 1):
            hashed = hashed[: len(piece) - size + 1] * np.uint64(0x100000001B3) + piece[size - 1 :] + np.uint64(size)
            if size in SIZES:
                ids = (hashed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)
                found.append(np.unique(ids if among is None else ids[among[ids]]))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Document counts of the features by class, once per partition."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic), features(text)] += 1
    found = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"feature": found, "clean": counts[0, found], "toxic": counts[1, found]})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int | None, sample: int = SAMPLE) -> DataFrame:
    """``(text, toxic)`` of the rows to learn from: label 0 or 1, doc_id not in the held-out fold.

    A doc_id that is labelled more than once has the largest of its labels. The ids kept are a hash range that holds
    ``sample`` of them on average; they are broadcast, being so few.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if folds:
        known = known.where(~held_out(folds))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("toxic"))
    n = known.count()
    if n > sample:
        known = known.where(F.expr(f"pmod(xxhash64('sample', doc_id), 1000000007) < {int(1000000007 * sample / n)}"))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return cut_lineage(rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic").repartition(SAMPLE_PARTS))


def held_out(folds: int = FOLDS) -> F.Column:
    """Whether a row is kept from learning; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def log_count_ratios(counts: DataFrame, n_clean: int, n_toxic: int) -> DataFrame:
    """``(feature, ratio)`` of the features whose ratios are at least ``MIN_Z`` standard errors from 0, the surest ones."""
    p, q, n, m = F.col("toxic") + SMOOTHING, F.col("clean") + SMOOTHING, n_toxic + 2 * SMOOTHING, n_clean + 2 * SMOOTHING
    ratio = F.log(p / n) - F.log(q / m)
    error = F.sqrt(F.greatest(1 / p - 1 / n + 1 / q - 1 / m, F.lit(1e-12)))
    rated = counts.select("feature", ratio.alias("ratio"), (F.abs(ratio) / error).alias("z")).where(F.col("z") >= MIN_Z)
    return rated.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).select("feature", "ratio")


def _logistic(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and intercept on the active features, by accelerated gradient steps on all rows at once."""
    n, width = len(y), len(scale)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int32)
    value = scale[column]
    squared = np.bincount(at, value * value, n)
    step = 4.0 / (squared.max(initial=0.0) + 1.0)
    w, b, v, c = np.zeros(width), 0.0, np.zeros(width), 0.0
    for k in range(400):
        z = np.bincount(at, value * v[column], n) + c
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        new = v - step * (np.bincount(column, value * g[at], width) / n + L2 * v)
        bias = c - step * g.mean()
        v, c = new + k / (k + 3) * (new - w), bias + k / (k + 3) * (bias - b)
        w, b = new, bias
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int | None = FOLDS, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """``(weights, intercept)``: the model as one weight per feature number.

    With no labelled row, or rows of one class only, all weights are 0 and the intercept is the log odds of the
    smoothed share of toxic rows (-1 for no rows at all).
    """
    rows = labelled_sample(docs, labels, label, folds, sample)
    sizes = dict(rows.groupBy("toxic").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return np.zeros(BUCKETS), float(np.log((n_toxic + 0.5) / (n_clean + 0.5))) if sizes else -1.0
    partial = rows.mapInPandas(_count, "feature bigint, clean bigint, toxic bigint")
    counts = partial.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    significant = log_count_ratios(counts, n_clean, n_toxic).collect()
    ratios = np.zeros(BUCKETS)
    for feature, ratio in significant:
        ratios[feature] = ratio
    used = np.flatnonzero(ratios)
    chosen = ratios != 0

    def active(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.searchsorted(used, features(t, chosen)).astype(np.int32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"active": found, "toxic": batch["toxic"]})

    fitted = rows.mapInPandas(active, "active binary, toxic int").toPandas()
    columns = [np.frombuffer(x, np.int32) for x in fitted["active"]]
    w, b = _logistic(columns, fitted["toxic"].to_numpy(float), ratios[used])
    weights = np.zeros(BUCKETS)
    weights[used] = w * ratios[used]
    return weights, float(b)


def probability(docs: DataFrame, model: tuple[np.ndarray, float]) -> F.Column:
    """The probability of label 1 for ``docs.text``, as a column; a null text is an empty one. No shuffle."""
    weights, intercept = model
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        active = shared.value != 0
        for batch in texts:
            z = np.array([shared.value[features(t, active)].sum(dtype=np.float64) for t in batch]) + intercept
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return scored(F.coalesce(docs["text"], F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``. Extra columns of ``docs`` play no part."""
    texts = docs.select("doc_id", "text")
    scored = texts.withColumn("score", probability(texts, fit(docs, labels, folds=folds)))
    return scored.select("doc_id", held_out(folds).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns; all labels may teach it."""
    return docs.where(probability(docs, fit(docs, labels, folds=None)) < THRESHOLD)
