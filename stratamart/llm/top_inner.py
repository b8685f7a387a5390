"""Exact top-k by inner product with norm buckets.

Of equal vectors the k + 1 smallest ids stay candidates: no other can be in a result.
Candidates are range-split by length into buckets of at most ``BUCKET`` vectors, longest
first. Queries travel in blocks of at most ``QUERIES``. Each query's k best of the first
buckets give a score that the k-th best cannot fall below. With it:

* a query block visits only the buckets whose longest vector could still reach it;
* inside a bucket a query needs cosine >= threshold / (its length * longest length); above
  one it skips the bucket; otherwise it takes whichever leaves fewer candidates: the
  vectors long enough (length pruning), or those whose value at the query's largest
  coordinate can belong to such a cosine (coordinate pruning);
* what is left is verified by exact integer products: in doubles where the lengths' product
  is below ``EXACT``, so that no sum can round; otherwise doubles with their error bound only
  choose which candidates are multiplied as integers of any size.

A component is floor(scale * value), whatever its size. A score that a 64-bit integer cannot
hold stops the query, as the cast of its SQL does, and so does a scaled value beyond the doubles.

Vectors that are null or hold nulls or non-finite values take no part, nor do null ids;
rows of the query's own id are not its candidates. Vectors of unequal length count as
filled up with zeros. Repeated rows are candidates each. Ties go to the smaller id. Long vectors
are taken whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import parts_for, stored, table
from stratamart.llm.registry import query

#: Vectors of a bucket: bounds the memory of a task and the size of a row.
BUCKET = 4096
QUERIES = 2048
#: Sums of products of integers stay exact in doubles while the lengths' product is below this.
EXACT = 2.0**53

_BLOCK = "block long, ids binary, vectors binary, width int, rows int, longest double"


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id long, v array<double>): floor(scale * component) of the rows that take part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    infinite = F.lit(float("inf"))
    usable = (
        F.col(key).isNotNull() & F.col(vector).isNotNull()
        & ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    )

    def whole(x: Column) -> Column:
        """Doubles from 2**53 on are integers already, and beyond the longs that floor gives."""
        y = x * F.lit(float(scale))
        beyond = F.raise_error(F.lit("scaled component beyond the range of doubles")).cast("double")
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).when(F.abs(y) == infinite, beyond).otherwise(y)

    return vectors.where(usable).select(F.col(key).cast("long").alias("id"), F.transform(wide, whole).alias("v"))


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors; the values are 4-byte integers where all of a block fit, else doubles."""
    cells = row["rows"] * row["width"]
    kind = "<f8" if len(row["vectors"]) == 8 * cells else "<i4"
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], kind).reshape(row["rows"], row["width"])


def _lengths(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((vectors * vectors).sum(1))


def blocks(points: DataFrame, size: int) -> DataFrame:
    """Rows of at most ``size`` vectors, each range-split by length (longest first inside and between partitions)."""
    spark = points.sparkSession
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    parts = max(parts_for(points.count(), 4 * size), 1)
    ranged = points.withColumn("l", length).repartitionByRange(parts, F.col("l").desc(), F.col("id")).sortWithinPartitions(F.col("l").desc(), "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, nth = [], [], 0
        part = _partition()

        def out():
            width = max(map(len, rows))
            full = np.zeros((len(rows), width), "<f8")
            for i, r in enumerate(rows):
                full[i, :len(r)] = r
            longest = float(_lengths(full).max())
            if np.abs(full).max(initial=0.0) < 2**31:
                full = full.astype("<i4")
            return pa.RecordBatch.from_pydict({
                "block": [part << 32 | nth], "ids": [np.array(ids, "<i8").tobytes()], "vectors": [full.tobytes()],
                "width": pa.array([width], pa.int32()), "rows": pa.array([len(rows)], pa.int32()), "longest": [longest]})

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                rows.append(v)
                if len(rows) == size:
                    yield out()
                    ids, rows, nth = [], [], nth + 1
        if rows:
            yield out()

    return ranged.select("id", "v").mapInArrow(pack, _BLOCK)


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def scores_in(q_ids, q, ids, p, k: int, floor: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k best candidates with a score of at least ``floor``.

    ``p`` is sorted by length, longest first. Ties go to the smaller id.
    """
    width = max(q.shape[1], p.shape[1])
    q, p = (np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(np.float64) for x in (q, p))
    q_len, p_len = _lengths(q), _lengths(p)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        exact = q_len * longest * (1 + 1e-9) < EXACT
        local = floor / (q_len * longest)  # the cosine that a candidate of the longest length needs
    # Room for rounding: pruning must not lose an exact tie.
    local = np.where(np.isfinite(local), local, np.where(floor > 0, 2.0, -1.0)) - 1e-9
    unit_q = q / np.maximum(q_len, 1e-300)[:, None]
    focus = np.abs(unit_q).argmax(1)
    out_q, out_p, out_s = [], [], []
    order_of, sorted_of = {}, {}
    dense = []
    for i in np.flatnonzero(exact & (local <= 1)):
        if local[i] <= 0:
            dense.append(i)
            continue
        enough = floor[i] / q_len[i] * (1 - 1e-9) - 1e-6
        by_length = int(np.searchsorted(-p_len, -enough, side="right"))
        f = int(focus[i])
        if f not in order_of:
            unit = p[:, f] / np.maximum(p_len, 1e-300)
            order_of[f] = np.argsort(unit, kind="stable")
            sorted_of[f] = unit[order_of[f]]
        c, t = unit_q[i, f], min(1.0, max(0.0, local[i]))
        reach = np.sqrt(max(0.0, 1 - c * c) * (1 - t * t))
        # Values x with c*x + sqrt((1-c^2)(1-x^2)) >= t, the most that the other coordinates allow.
        low = c * t - reach if t > -c else -1.0
        high = c * t + reach if t > c else 1.0
        a, b = np.searchsorted(sorted_of[f], [low - 1e-7, high + 1e-7], side="left")
        if b - a < by_length:
            rows = order_of[f][a:b]
        elif by_length < 0.75 * len(p):
            rows = np.arange(by_length)
        else:
            dense.append(i)
            continue
        _take(out_q, out_p, out_s, np.array([i]), rows, (p[rows] @ q[i])[None, :], q_ids, ids, k, floor)
    for at in range(0, len(dense), 256):
        some = np.array(dense[at:at + 256])
        _take(out_q, out_p, out_s, some, np.arange(len(p)), q[some] @ p.T, q_ids, ids, k, floor)
    for i in np.flatnonzero(~exact):
        _take_wide(out_q, out_p, out_s, i, q[i], p, q_len[i] * p_len, q_ids, ids, k, floor)
    # Scores in doubles are integers below 2**53; each part is cast alone, so that wide ones stay exact.
    join = lambda parts, kind: np.concatenate([*(x.astype(kind) for x in parts), np.zeros(0, kind)])
    return join(out_q, np.int64), join(out_p, np.int64), join(out_s, np.int64)


def _take(out_q, out_p, out_s, queries, rows, scores, q_ids, ids, k, floor) -> None:
    for i, row in zip(queries.tolist(), scores):
        fit = np.flatnonzero((row >= floor[i]) & (ids[rows] != q_ids[i]))
        if len(fit) > k:
            bound = -np.partition(-row[fit], k - 1)[k - 1]
            fit = fit[row[fit] >= bound]
            fit = fit[np.lexsort((ids[rows[fit]], -row[fit]))[:k]]
        out_q.append(np.full(len(fit), i))
        out_p.append(rows[fit])
        out_s.append(row[fit])


def _take_wide(out_q, out_p, out_s, i, query, p, reach, q_ids, ids, k, floor) -> None:
    """The k best of one query whose sums may round: ``reach`` bounds the sums of the products' sizes."""
    fit = np.flatnonzero(ids != q_ids[i])
    if np.isfinite(reach).all():
        rough, error = p @ query, reach * (len(query) + 4) * 2.0**-52
        fit = fit[(rough + error)[fit] >= floor[i]]
        if len(fit) > k:
            least = (rough - error)[fit]
            fit = fit[(rough + error)[fit] >= np.partition(least, len(fit) - k)[len(fit) - k]]
    whole = [int(x) for x in query.tolist()]
    scored = [(sum(a * int(b) for a, b in zip(whole, p[j].tolist()) if a), int(ids[j]), j) for j in fit.tolist()]
    low = float(floor[i])  # Python compares integers with its own floats exactly
    best = sorted((-s, d, j) for s, d, j in scored if s >= low)[:k]
    if any(not -2**63 <= -s < 2**63 for s, _, _ in best):
        raise OverflowError(f"a score of query {q_ids[i]} does not fit a 64-bit integer")
    out_q.append(np.full(len(best), i))
    out_p.append(np.array([j for _, _, j in best], np.int64))
    out_s.append(np.array([-s for s, _, _ in best], np.int64))


def top_inner(vectors: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of each query row with all other rows."""
    spark = vectors.sparkSession
    # Of equal vectors only the k + 1 smallest ids can be among any query's k best. Spark limits each
    # group inside its tasks before the shuffle, so a very common vector is no hot group.
    order = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    points = quantised(vectors, key, vector, scale).withColumn("nth", order).where(F.col("nth") <= k + 1).drop("nth")
    probes = stored(blocks(points, BUCKET), "norm-buckets")
    asked = stored(blocks(quantised(vectors.where(queries), key, vector, scale), QUERIES), "query-blocks")
    # One number and one length for each bucket of BUCKET vectors.
    buckets = probes.select("block", "longest", "rows").orderBy(F.col("longest").desc(), "block").collect()
    if not buckets:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # The first bucket with more than k vectors gives every query its floor (no bucket: no floor).
    seeds = [b.block for b in buckets if b.rows > k + 1][:1] or [buckets[0].block]
    pairs_schema = "query_id long, vec_id long, score long"

    # A seed bucket is one row of at most BUCKET vectors.
    first = spark.sparkContext.broadcast(probes.where(F.col("block") == seeds[0]).first().asDict())

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _matrix(row)
                ids, p = _matrix(first.value)
                i, j, s = scores_in(q_ids, q, ids, p, k, np.full(len(q), -np.inf), first.value["longest"])
                best = np.full(len(q), -np.inf)
                count = np.bincount(i, minlength=len(q))
                np.minimum.at(low := np.full(len(q), np.iinfo(np.int64).max), i, s)
                # As doubles the floors may only round down.
                below = low.astype(float)
                below = np.where(np.abs(below) < EXACT, below, np.nextafter(below, -np.inf))
                best[count >= k] = below[count >= k]
                yield pa.RecordBatch.from_pydict({"block": [row["block"]], "floors": [best.astype("<f8").tobytes()]})

    named = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns])
    floors = asked.mapInArrow(seed, "block long, floors binary")
    lengths, numbers = np.array([b.longest for b in buckets]), np.array([b.block for b in buckets])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The buckets that any query of a block must look into: a prefix of the buckets by length."""
        for batch in batches:
            for row in batch.to_pylist():
                q = _matrix(row)[1].astype(float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.frombuffer(row["floors"], "<f8") / _lengths(q)
                need = np.where(np.isnan(need), 0, need).min()
                need -= 1e-9 * abs(need) + 1e-6
                upto = int(np.searchsorted(-lengths, -need, side="right"))
                yield pa.RecordBatch.from_pydict({"q_block": [row["block"]] * upto, "block": numbers[:upto].tolist(), "floors": [row["floors"]] * upto})

    visits = asked.join(floors, "block").mapInArrow(visit, "q_block long, block long, floors binary")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _matrix({n: row["q_" + n] for n in ("ids", "vectors", "rows", "width")})
                ids, p = _matrix(row)
                i, j, s = scores_in(q_ids, q, ids, p, k, np.frombuffer(row["floors"], "<f8"), row["longest"])
                yield pa.RecordBatch.from_pydict({"query_id": q_ids[i], "vec_id": ids[j], "score": s})

    work = visits.repartition(max(parts_for(len(buckets), 1), 1), "block").join(probes, "block").join(named, "q_block")
    found = work.mapInArrow(verify, pairs_schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score
  FROM points q JOIN points p ON q.vec_id % 20 = 0 AND p.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


@query(SQL)
def op5_top_inner(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest products of every 20th vector with all others."""
    return top_inner(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)
