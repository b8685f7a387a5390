"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

1. A logistic regression on surface statistics of the whole text gives each document the
   probability p that it is good. It is fitted on at most ``MAX_ROWS`` labelled rows of
   each class, those with the smallest hash of their key.
2. Grouped sums of p by host and by path (a section of a host) feed beta posteriors. The
   strength of each prior is estimated by moments from the spread between groups, so
   a sparse path shrinks to its host and a sparse host to the global rate.
3. A document's log odds are its own, plus those of its path's posterior without the
   document itself, minus the global ones.

Nulls: a null text is an empty one, null hosts and paths are groups of their own. Without
labels of both classes every p is the share of good labels (1 without any). Repeated rows
count each. Very long texts are taken whole. An empty table gives no rows. Other columns pass
through; columns good and quality of the input are replaced by ``classify`` and kept by ``drop_poor``.
Ties: a document exactly at the threshold stays. Odds are cut only to stay finite: a document's own
at e**12, probabilities of groups at 1e-6. Group sums are combined before the shuffle, so a hot host is one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import distinct, labelled_sample, own_names, stored, table, text_buffer, word_hashes, word_spans
from stratamart.llm.registry import query

#: Bound of the training sample, rows of each class.
MAX_ROWS = 8_000
#: Documents below this posterior are rejected.
THRESHOLD = 0.5
#: Texts whose statistics are computed together.
TOGETHER = 256

_SPACE, _LOWER, _UPPER, _DIGIT, _POINT, _SIGN = range(6)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[128:] = _LOWER  # pieces of letters outside ASCII
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[ord(c) for c in ".,;:?'\"()-/"]] = _POINT


def surface(texts: pa.Array) -> np.ndarray:
    """One row of statistics for each text, from all of its bytes; a few hundred texts at a time bound the memory."""
    parts = [_surface(texts.slice(at, TOGETHER)) for at in range(0, len(texts), TOGETHER)]
    return np.concatenate([np.zeros((0, 15)), *parts])


def _surface(texts: pa.Array) -> np.ndarray:
    data, offsets = text_buffer(texts)
    n, sizes = len(texts), np.diff(offsets)
    kind = _CLASS[data]
    counts = np.bincount(np.repeat(np.arange(n) * 6, sizes) + kind, minlength=6 * n).reshape(n, 6)
    starts, stops, owner = word_spans(data, offsets, _CLASS != _SPACE)
    words = np.bincount(owner, minlength=n)
    hashes = word_hashes(data, starts, stops)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    signs = np.concatenate([[0], np.cumsum(kind == _SIGN)])
    marked = signs[stops] > signs[starts]
    size, some = np.maximum(sizes, 1), np.maximum(words, 1)
    letters = counts[:, _LOWER] + counts[:, _UPPER]
    upper = counts[:, _UPPER] / np.maximum(letters, 1)
    sign, marks = counts[:, _SIGN] / size, np.bincount(owner[marked], minlength=n) / some
    repeats = np.bincount(owner[same], minlength=n) / some
    return np.column_stack([
        np.log1p(sizes), letters / size, upper, counts[:, _DIGIT] / size, counts[:, _POINT] / size, sign,
        letters / some, marks, repeats, np.log1p(_distinct_words(owner, hashes, n)) / np.log1p(some),
        np.sqrt(upper), np.sqrt(sign), np.sqrt(marks), np.sqrt(repeats), words == 0,
    ])


def _distinct_words(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct words of each of at most 65536 texts (48 bits of a hash tell words apart)."""
    keys = distinct(owner.astype(np.uint64) << np.uint64(48) | hashes >> np.uint64(16))
    return np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=n)


@dataclass
class Evidence:
    """Logistic regression on standardised statistics."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    intercept: float

    def good(self, texts: pa.Array) -> np.ndarray:
        z = self.intercept + ((surface(texts) - self.centre) / self.spread) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def fit_evidence(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                 learn: Column | None = None) -> Evidence:
    sample, totals = labelled_sample(labels, key, label, learn, MAX_ROWS)
    share = totals.get(1, 0) / sum(totals.values()) if totals else 1.0
    blank = Evidence(np.zeros(15), np.ones(15), np.zeros(15), float(np.clip(24 * share - 12, -12, 12)))
    if not 0 < share < 1:
        return blank
    # Bounded broadcast: at most 2 * MAX_ROWS keys.
    chosen = docs.select(F.col(f"`{key}`").alias("__k"), F.col(f"`{text}`").cast("string").alias("__t")).join(
        F.broadcast(sample.withColumnRenamed(key, "__k")), "__k").select("__k", "__y", "__t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(surface(batch.column(2)).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["__k", "__y", "x"])

    schema = chosen.select("__k", "__y", F.array(F.lit(0.0)).alias("x")).schema
    seen = chosen.mapInArrow(run, schema).groupBy("__k").agg(F.max("__y").alias("y"), F.max("x").alias("x")).orderBy("__k").toPandas()
    if seen.y.nunique() < 2:
        return blank
    x, y = np.stack(seen.x.to_list()), seen.y.to_numpy(float)
    centre, spread = x.mean(0), x.std(0) + 1e-6
    x = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    # Sampling the classes unevenly is undone by row weights.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 1.0
    ridge[-1, -1] = 1e-3
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Evidence(centre, spread, w[:-1], float(w[-1]))


def with_evidence(docs: DataFrame, model: Evidence, text: str = "text", good: str = "good") -> DataFrame:
    """``docs`` with the document's own probability of being good."""
    names = [c for c in docs.columns if c != good]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.good(batch.column(at)))], [*names, good])

    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    return kept.mapInArrow(run, kept.withColumn(good, F.lit(0.0)).schema)


def _prior_strength(groups: DataFrame, mean: Column) -> float:
    """Beta prior strength whose spread is the spread of group rates beyond that of sampling; ``groups`` has n and total."""
    rate = F.col("total") / F.col("n")
    row = groups.agg(
        (F.sum(F.col("n") * (rate - mean) * (rate - mean)) / F.sum("n")).alias("between"), F.max(mean * (1 - mean)).alias("most"),
        (F.count("*") / F.sum("n")).alias("share")).first()
    if row["most"] is None:
        return 1.0
    return min(max(row["most"] / max(row["between"] - row["most"] * row["share"], 1e-6) - 1, 1.0), 1e6)


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """(host, path, n, total, prior, strength, rate) of each path from rows of (host, path, good).

    ``prior`` is the host's posterior mean, itself shrunk to the global ``rate``;
    ``strength`` is how many documents the prior weighs. Groups with null keys are kept.
    Only the global rate and the two strengths reach the driver.
    """
    paths = stored(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("total")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rate = F.lit(hosts.agg(F.sum("total") / F.sum("n")).first()[0]).cast("double")
    weight = _prior_strength(hosts, rate)
    hosts = hosts.select(F.col("host").alias("__host"), ((weight * rate + F.col("total")) / (weight + F.col("n"))).alias("prior"))
    joined = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("__host"))).drop("__host"), "quality-priors")
    return joined.select("*", F.lit(_prior_strength(joined, F.col("prior"))).alias("strength"), rate.alias("rate"))


def classify(docs: DataFrame, model: Evidence, host: Column, path: Column, text: str = "text") -> DataFrame:
    """``docs`` with ``good`` (its own probability) and ``quality`` (the posterior).

    Two passes over the texts: one for the group sums, one for the result; only the
    path table is joined, which Spark broadcasts when its stored size is small.
    """
    narrow = with_evidence(docs.select(host.alias("host"), path.alias("path"), F.col(f"`{text}`").cast("string").alias("text")), model)
    sites = stored(site_posteriors(narrow.drop("text")), "quality-sites")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("good", "quality")])
    own = dict(zip(_SITE, own_names(kept, *_SITE)))
    h, p, good = own_names(kept, "h", "p", "good")
    rows = with_evidence(kept.withColumn(h, host).withColumn(p, path), model, text, good)
    joined = rows.join(sites.select(*[F.col(c).alias(own[c]) for c in _SITE]), F.col(h).eqNullSafe(F.col(own["host"])) & F.col(p).eqNullSafe(F.col(own["path"])))
    quality = posterior(F.col(good), *[F.col(own[c]) for c in _SITE[2:]])
    return joined.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(good).alias("good"), quality.alias("quality"))


_SITE = ("host", "path", "n", "total", "prior", "strength", "rate")


def posterior(good: Column, n: Column, total: Column, prior: Column, strength: Column, rate: Column) -> Column:
    """Posterior of a document from its path's sums, which count without the document itself."""
    def logit(p: Column) -> Column:
        p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
        return F.log(p / (1 - p))

    others = (strength * prior + total - good) / (strength + n - 1)
    return 1 / (1 + F.exp(-(logit(good) + logit(others) - logit(rate))))


def document_sites(docs: DataFrame) -> tuple[Column, Column]:
    """Of the table ``documents``: the source is the host, its pages in one language are a path."""
    return F.col("source"), F.col("lang")


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents at or above the threshold; columns unchanged."""
    row = own_names(docs, "row")[0]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)) if {"good", "quality"} & set(docs.columns) else None
    if packed is not None:  # columns of these names travel inside a struct
        docs = packed.select(row, *[F.col(f"{row}.{c}") for c in ("doc_id", "text", "source", "lang")])
    kept = classify(docs, fit_evidence(docs, labels), *document_sites(docs)).where(F.col("quality") >= threshold)
    return kept.select(f"{row}.*") if packed is not None else kept.select(*[f"`{c}`" for c in docs.columns])


@query()
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its own and its posterior probability of being good."""
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    scored = classify(docs.select("doc_id", "text", "source", "lang"), fit_evidence(docs, labels), *document_sites(docs))
    return scored.select("doc_id", "good", "quality", (F.col("quality") >= THRESHOLD).alias("kept"))
