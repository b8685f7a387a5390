"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of its lower-cased whole
text. Every n-gram of the training rows is counted by class in Spark; its log-count
ratio scales the feature, and a logistic regression is fitted on the scaled features.
The classifier is fitted on at most ``MAX_ROWS`` labelled rows of each class, those with
the smallest hash of their key; the class balance of all labelled rows corrects the
intercept. Scoring covers every row and every character.

Nulls and empty texts get the score of a text without features. Rows whose label or key
is null are not learned from; a key labelled more than once counts by its largest label, and of a
key's texts the largest is learned from. Very long texts are taken whole. An empty table gives no
rows. A column ``score`` of the input is replaced, other columns pass through; ``drop_toxic`` keeps all.
Ties: a score exactly at the threshold marks a text.
With no training row, or only one class, every score is that class's share (0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import crc_mod, drop_stored, labelled_sample, mix64, own_names, stored, table
from stratamart.llm.registry import query

#: Bound of the training sample, rows of each class.
MAX_ROWS = 6_000
ORDERS = (4, 6, 8)
BUCKET_BITS = 22
#: N-grams in fewer training rows than this carry no weight.
MIN_ROWS = 3
#: At most so many n-grams keep a weight (a property of the model, not of the texts).
MAX_WEIGHTS = 40_000
#: Rows whose margins are summed together while fitting.
TOGETHER = 512
#: A score from here on marks a text.
THRESHOLD = 0.3

_MULTIPLIERS = mix64(np.arange(1, 1 + max(ORDERS), dtype=np.uint64)) | np.uint64(1)


def grams(text: str | None) -> np.ndarray:
    """Buckets of the character n-grams of a whole text, with repeats; spaces stand before and after it."""
    if not text:
        return np.zeros(0, np.int64)
    chars = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    found, rolling = [], np.zeros(len(chars), np.uint64)
    for k in range(min(max(ORDERS), len(chars))):
        rolling = rolling[:len(chars) - k] + chars[k:] * _MULTIPLIERS[k]
        if k + 1 in ORDERS:
            mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
            found.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate([*found, np.zeros(0, np.int64)])


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def __getstate__(self):
        """Only the weights that are not 0 travel."""
        kept = np.flatnonzero(self.weights)
        return len(self.weights), kept, self.weights[kept], self.intercept

    def __setstate__(self, state) -> None:
        size, kept, values, self.intercept = state
        self.weights = np.zeros(size, values.dtype)
        self.weights[kept] = values

    def score(self, text: str | None) -> float:
        """A text's features are distinct n-grams; most have no weight and drop out before they are made distinct."""
        found = grams(text)
        found = np.unique(found[self.weights[found] != 0])
        z = self.intercept + float(self.weights[found].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        learn: Column | None = None) -> Model:
    sample, totals = labelled_sample(labels, key, label, learn, MAX_ROWS)
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if not 0 < share < 1:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 35.0 * (2 * share - 1))
    # The sample has at most 2 * MAX_ROWS keys, so this broadcast is bounded. A key that occurs in
    # several documents is learned from once.
    chosen = docs.select(F.col(f"`{key}`").alias("__k"), F.col(f"`{text}`").cast("string").alias("__t")).join(
        F.broadcast(sample.withColumnRenamed(key, "__k")), "__k")
    rows = stored(chosen.groupBy("__k", "__y").agg(F.max("__t").alias("__t")), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y, np.unique(grams(t))] += 1
        some = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some], pa.int64()), pa.array(counts[1, some], pa.int64())], ["b", "n0", "n1"])

    counted = stored(
        rows.select("__y", "__t").mapInArrow(count, "b long, n0 long, n1 long").groupBy("b")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= MIN_ROWS), "toxicity-counts")
    # Only the strongest n-grams reach the driver.
    sums = counted.agg(F.sum(F.col("n0") + 1).alias("s0"), F.sum(F.col("n1") + 1).alias("s1")).first()
    ratio = log_count_ratio(F.col("n0"), F.col("n1"), sums["s0"] or 1, sums["s1"] or 1)
    strength = F.abs(F.col("ratio")) * F.sqrt(F.col("n0") + F.col("n1"))
    strong = counted.withColumn("ratio", ratio).orderBy(strength.desc(), "b").limit(MAX_WEIGHTS).select("b", "ratio").toPandas().sort_values("b")
    drop_stored(counted)
    kept, scale = strong.b.to_numpy(np.int64), strong.ratio.to_numpy(float)
    del strong

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << BUCKET_BITS, -1, np.int32)
        number[kept] = np.arange(len(kept))
        for batch in batches:
            ids = [np.unique((n := number[grams(t)])[n >= 0]).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, pa.binary())], ["k", "y", "ids"])

    data = rows.select("__k", "__t", "__y").mapInArrow(select, rows.select(F.col("__k").alias("k"), F.col("__y").alias("y"), F.lit(b"").alias("ids")).schema).toPandas()
    drop_stored(rows)
    data = data.sort_values("k", key=lambda k: pd.util.hash_array(k.to_numpy()), kind="stable")
    y = data.y.to_numpy(float)
    if data.y.nunique() < 2:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share))))
    ids = [np.frombuffer(x, "<u4") for x in data.ids]
    del data
    weights, intercept = logistic(ids, y, scale)
    sampled = y.mean()
    intercept += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    full = np.zeros(1 << BUCKET_BITS, np.float32)
    full[kept] = weights
    return Model(full, float(intercept))


def log_count_ratio(negative: Column, positive: Column, all_negative: int, all_positive: int) -> Column:
    """Log ratio of the smoothed shares of an n-gram in the two classes."""
    return F.log((positive + 1) / all_positive) - F.log((negative + 1) / all_negative)


def logistic(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, steps: int = 200, ridge: float = 0.02):
    """Weights of a logistic regression on ``scale``-d indicator features (Adam, full batch, balanced classes)."""
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])

    def margins(weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each row, some rows at a time: no array beside ``flat`` is as long for good."""
        parts = [np.zeros(0)]
        for i in range(0, len(rows), TOGETHER):
            n = sizes[i:i + TOGETHER]
            ids = flat[begin[i]:begin[i + len(n)]]
            parts.append(np.bincount(np.repeat(np.arange(len(n)), n), weights=weights[ids], minlength=len(n)))
        return np.concatenate(parts)

    # Each row is scaled to unit length in the mean, so that the step size suits any text length.
    norm = np.sqrt(max(1e-9, (scale[flat] ** 2).sum() / max(1, len(rows))))
    value = scale / norm
    w, b = np.zeros(len(scale)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        z = b + margins(w * value)
        error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        grad = np.bincount(flat, weights=np.repeat(error, sizes), minlength=len(scale)) * value / len(rows) + ridge * w / len(rows)
        grad_b = error.mean()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b**2
        fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.05 * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        b -= 0.05 * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return w * value, b


def with_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score`` in 0..1; the model (fixed size) is shipped with the function."""
    keep = [c for c in docs.columns if c != score]
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*keep, score])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    return kept.mapInArrow(run, kept.withColumn(score, F.lit(0.0)).schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents below the threshold, fitted on the labels of ``docs`` themselves; columns unchanged."""
    model = fit(docs, labels)
    name = own_names(docs, "score")[0]
    return with_score(docs, model, score=name).where(F.col(name) < threshold).select(*[f"`{c}`" for c in docs.columns])


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A score for every document; rows of remainder 2 are never learned from."""
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    model = fit(docs, labels, learn=crc_mod(F.col("doc_id"), 4) != 2)
    scored = with_score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
